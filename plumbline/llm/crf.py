"""Linear-chain conditional random field with two labels, for many sequences at once.

A sequence has an emission score per item (for label 1; label 0 has 0) and one transition score
per pair of labels. The forward and the backward pass follow the odds of label 1; a step is a
Moebius map, so that steps compose: sequences are cut into short chunks, all chunks run side by
side, their maps are chained, and all chunks run again from the right odds. The result is exact.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np

#: Items of a chunk.
CHUNK = 32
#: Bound of emission scores, which keeps odds in the range of doubles.
BOUND = 30.0


def odds(emission: np.ndarray, lengths: np.ndarray, step: np.ndarray) -> np.ndarray:
    """r with r[0] = E[0] in each sequence and r[i] = E[i] (r s11 + s01) / (r s10 + s00) after it.

    ``emission`` holds E > 0 of all sequences in a row, ``lengths`` (each above 0) their sizes.
    """
    n = len(emission)
    out = np.empty(n)
    if not n:
        return out
    s00, s01, s10, s11 = step[0, 0], step[0, 1], step[1, 0], step[1, 1]
    parts = -(-lengths // CHUNK)
    begin = np.cumsum(lengths) - lengths
    number = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    start = np.repeat(begin, parts) + number * CHUNK
    size = np.minimum(np.repeat(begin + lengths, parts) - start, CHUNK)
    order = np.argsort(-size, kind="stable")
    begins, heads = start[order], (number == 0)[order]
    active = np.searchsorted(-size[order], -np.arange(CHUNK), "left")
    # The map of each chunk, as the matrix (a b; c d) of r -> (a r + b) / (c r + d).
    a, b = np.ones(len(order)), np.zeros(len(order))
    c, d = np.zeros(len(order)), np.ones(len(order))
    longer = int(parts.max()) > 1
    if longer:
        for j in range(CHUNK):
            k = active[j]
            if not k:
                break
            e = emission[begins[:k] + j]
            na, nb = e * (s11 * a[:k] + s01 * c[:k]), e * (s11 * b[:k] + s01 * d[:k])
            nc, nd = s10 * a[:k] + s00 * c[:k], s10 * b[:k] + s00 * d[:k]
            if j == 0:  # nothing comes before the first item of a sequence
                h = heads[:k]
                na[h], nc[h], nb[h], nd[h] = 0.0, 0.0, e[h], 1.0
            scale = 1.0 / np.maximum(np.maximum(na, nb), np.maximum(nc, nd))
            a[:k], b[:k], c[:k], d[:k] = na * scale, nb * scale, nc * scale, nd * scale
    came = np.ones(len(order))
    if longer:
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        first = np.cumsum(parts) - parts
        by = np.argsort(-parts, kind="stable")
        counts, first = parts[by], first[by]
        r = np.ones(len(parts))
        for j in range(int(parts.max()) - 1):
            k = int(np.searchsorted(-counts, -(j + 1), "left"))
            at = place[first[:k] + j]
            r[:k] = (a[at] * r[:k] + b[at]) / (c[at] * r[:k] + d[at])
            came[place[first[:k] + j + 1]] = r[:k]
    r = came
    for j in range(CHUNK):
        k = active[j]
        if not k:
            break
        before = r[:k]
        ratio = (before * s11 + s01) / (before * s10 + s00)
        if j == 0:
            ratio = np.where(heads[:k], 1.0, ratio)
        r[:k] = emission[begins[:k] + j] * ratio
        out[begins[:k] + j] = r[:k]
    return out


def marginals(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray,
              pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """P(label 1) of every item and, if asked for, the expected number of each label pair."""
    lengths = lengths[lengths > 0]
    e, step = np.exp(np.clip(scores, -BOUND, BOUND)), np.exp(transitions)
    ahead = odds(e, lengths, step)
    back = odds(e[::-1], lengths[::-1], step.T)[::-1]  # emission included
    p = ahead * back / (e + ahead * back)
    if not pairs:
        return p, None
    last = np.cumsum(lengths) - 1
    inner = np.ones(len(e), bool)
    inner[last] = False
    f, g = ahead[inner], back[np.flatnonzero(inner) + 1]
    weights = [step[0, 0] + 0 * f, step[0, 1] * g, step[1, 0] * f, step[1, 1] * f * g]
    total = sum(weights)
    return p, np.array([(w / total).sum() for w in weights]).reshape(2, 2)


@dataclass(frozen=True)
class Part:
    """Some whole sequences: ``emission(w)`` gives the scores of their items, ``gradient(d)`` the sum
    of d times the features of each weight."""

    emission: Callable[[np.ndarray], np.ndarray]
    gradient: Callable[[np.ndarray], np.ndarray]
    lengths: np.ndarray
    labels: np.ndarray


def label_pairs(part: Part) -> np.ndarray:
    """How often each label follows each other one inside the sequences."""
    inner = np.ones(len(part.labels), bool)
    inner[np.cumsum(part.lengths[part.lengths > 0]) - 1] = False
    at = np.flatnonzero(inner)
    return np.bincount(part.labels[at] * 2 + part.labels[at + 1], minlength=4).reshape(2, 2)


def fit_parts(size: int, parts: Sequence[Part], steps: int, rate: float, decay: float
              ) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions that fit the labels of all parts, by Adam on the conditional likelihood.

    Every step sees all items, one part after the other, so that working memory follows the largest
    part.
    """
    w, t = np.zeros(size), np.zeros((2, 2))
    n = max(1, sum(len(part.labels) for part in parts))
    seen = sum((label_pairs(part) for part in parts), np.zeros((2, 2)))
    moments = [np.zeros(size + 4), np.zeros(size + 4)]
    for i in range(1, steps + 1):
        slope, expected = np.zeros(size), np.zeros((2, 2))
        for part in parts:
            p, pairs = marginals(part.emission(w), part.lengths, t, pairs=True)
            slope += part.gradient(part.labels - p)
            expected += pairs
        g = np.r_[slope / n - decay * w, ((seen - expected) / n).ravel()]
        moments[0] = 0.9 * moments[0] + 0.1 * g
        moments[1] = 0.999 * moments[1] + 0.001 * g * g
        move = rate * moments[0] / (1 - 0.9 ** i) / (
            np.sqrt(moments[1] / (1 - 0.999 ** i)) + 1e-9)
        w = w + move[:size]
        t = np.clip(t + move[size:].reshape(2, 2), -4, 4)
    return w, t


def fit(size: int, emission: Callable[[np.ndarray], np.ndarray],
        gradient: Callable[[np.ndarray], np.ndarray], lengths: np.ndarray, labels: np.ndarray,
        steps: int, rate: float, decay: float) -> tuple[np.ndarray, np.ndarray]:
    """:func:`fit_parts` of one part."""
    return fit_parts(size, [Part(emission, gradient, lengths, labels)], steps, rate, decay)


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a one-variable logistic regression, by Newton steps that ascend."""
    middle, scale = float(np.mean(x)), float(np.std(x)) or 1.0
    z, penalty = (x - middle) / scale, 1e-5 * weight.sum()

    def value(c: np.ndarray) -> float:
        m = c[0] * z + c[1]
        return float((weight * (y * m - np.logaddexp(0, m))).sum() - penalty * (c @ c) / 2)

    c = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(c[0] * z + c[1], -BOUND, BOUND)))
        v = p * (1 - p) * weight
        g = np.array([((y - p) * z * weight).sum(), ((y - p) * weight).sum()]) - penalty * c
        h = np.array([[(v * z * z).sum(), (v * z).sum()], [(v * z).sum(), v.sum()]])
        move = np.linalg.solve(h + penalty * np.eye(2), g)
        while value(c + move) < value(c) and np.abs(move).max() > 1e-9:
            move /= 2
        c = c + move
        if np.abs(move).max() < 1e-9:
            break
    return float(c[0] / scale), float(c[1] - c[0] * middle / scale)
