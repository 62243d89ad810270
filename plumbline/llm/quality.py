"""Quality: a linear-chain conditional random field labels every line good or bad.

Line features are shares of character classes, repetition and lengths, cut into steps, of the
line and of its two neighbours. Labels are of documents, so the field starts from lines that carry
their document's label; after a first fit, lines of bad documents that it holds for clearly good
are relabelled and it is fitted again. Forward-backward marginals give each line's probability to
be good; their mean, weighted by line length, is the document's quality, and a logistic curve
fitted on the same sample puts its threshold at one half.

The fit reads a bounded sample of labelled rows (``SAMPLE`` documents per label, those of smallest
hashed id); scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import crf
from plumbline.llm import text as T
from plumbline.llm.tables import pieces, remainder, result_schema, texts_of
from plumbline.llm.toxicity import training_sample

#: Training documents per label.
SAMPLE = 2500
STEPS, RATE, DECAY = 120, 0.1, 1e-5
#: A line of a bad document is relabelled good from this probability on.
CLEARLY_GOOD = 0.8

#: Steps at which a share counts as one more feature.
SHARES = (0.01, 0.05, 0.15, 0.3, 0.6, 0.9)
#: Steps of word length in bytes, and of line length.
WORD_LENGTH, LINE_LENGTH = (2.0, 3.5, 5.0, 7.0, 10.0, 20.0), (1, 20, 80, 300, 1000, 4000)


def byte_kinds() -> np.ndarray:
    """One row per class: upper case, digits, stops, exclamation, bars, other signs, beyond ASCII."""
    kinds = np.zeros((7, 256), np.int32)
    kinds[0, 65:91] = 1
    kinds[1, 48:58] = 1
    kinds[2, [44, 46, 59, 58]] = 1
    kinds[3, [33, 63]] = 1
    kinds[4, 124] = 1
    signs = [b for b in range(33, 127) if not chr(b).isalnum() and b not in (44, 46, 59, 58, 33, 63, 124)]
    kinds[5, signs] = 1
    kinds[6, 128:] = 1
    return kinds


KINDS = byte_kinds()


def lines(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of every line; an empty text has one empty line."""
    rows = len(bounds) - 1
    feed = np.flatnonzero(data == 10)
    owner = np.r_[np.arange(rows), np.searchsorted(bounds, feed, "right") - 1]
    start = np.r_[bounds[:-1], feed + 1]
    order = np.lexsort((start, owner))
    start, owner = start[order], owner[order]
    end = np.empty_like(start)
    end[:-1] = start[1:] - 1
    last = np.r_[owner[1:] != owner[:-1], True] if rows else np.zeros(0, bool)
    end[last] = bounds[owner[last] + 1]
    return start, end, owner


def line_features(data: np.ndarray, bounds: np.ndarray
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """0/1 features of each line with its neighbours' (items x features), bytes, and text."""
    start, end, owner = lines(data, bounds)
    size = end - start
    counts = []
    for kind in KINDS:
        sums = np.zeros(len(data) + 1, np.int32)
        np.cumsum(kind[data], out=sums[1:])
        counts.append(sums[end] - sums[start])
    w_start, w_end, w_text = T.words(data, bounds, T.SPACED)
    hashes = T.span_hash(T.prefix(data, T.FOLDED), w_start, w_end)
    # Line of each word: lines in text order; empty ones hold none.
    at = np.searchsorted(start, w_start, "right") - 1
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (at[1:] == at[:-1])
    n_words = np.bincount(at, minlength=len(start))
    again = np.bincount(at[same], minlength=len(start))
    letters = np.bincount(at, weights=w_end - w_start, minlength=len(start))
    # Distinct words of a line.
    pair = T.mix(hashes + at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(pair)
    fresh = np.zeros(len(pair), bool)
    fresh[order] = np.r_[True, np.diff(pair[order]) != 0] if len(pair) else fresh
    distinct = np.bincount(at[fresh], minlength=len(start))
    per_word, per_byte = np.maximum(n_words, 1), np.maximum(size, 1)
    shares = [counts[0] / np.maximum(letters, 1), counts[1] / per_byte, counts[2] / per_word,
              counts[3] / per_word, counts[4] / per_word, counts[5] / per_word,
              counts[6] / per_byte, again / per_word, distinct / per_word]
    columns = [s >= step for s in shares for step in SHARES]
    columns += [letters / per_word >= step for step in WORD_LENGTH]
    columns += [size >= step for step in LINE_LENGTH]
    own = np.array(columns, np.float32).T.reshape(len(start), len(columns))
    before, after = np.zeros_like(own), np.zeros_like(own)
    joined = owner[1:] == owner[:-1]
    before[1:][joined] = own[:-1][joined]
    after[:-1][joined] = own[1:][joined]
    return (np.concatenate([own, before, after, np.ones((len(start), 1), np.float32)], 1),
            size, owner)


@dataclass
class Model:
    weights: np.ndarray
    transitions: np.ndarray
    slope: float
    intercept: float


def document_quality(p: np.ndarray, size: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """Length-weighted mean of the lines' probabilities; a line counts one byte at least."""
    weight = np.maximum(size, 1)
    return np.bincount(owner, weights=p * weight, minlength=rows) / np.bincount(
        owner, weights=weight, minlength=rows)


def fit(labelled: DataFrame) -> Model:
    """A model from a bounded sample of rows (text, quality) with labels 0 and 1.

    Without rows of both labels every score is the share of good rows (0.5 without rows).
    """
    rows = labelled.select("text", "quality").toArrow()
    good = rows["quality"].to_numpy().astype(np.int64)
    if not len(good) or good.min() == good.max():
        share = float(np.clip(good.mean() if len(good) else 0.5, 1e-3, 1 - 1e-3))
        return Model(np.zeros(0), np.zeros((2, 2)), 0.0, float(np.log(share / (1 - share))))
    features, sizes, owners = [], [], []
    for first, _, data, bounds in T.slices(rows["text"]):
        x, n, owner = line_features(data, bounds)
        features.append(x)
        sizes.append(n)
        owners.append(owner + first)
    x, n, owner = np.concatenate(features), np.concatenate(sizes), np.concatenate(owners)
    lengths = np.bincount(owner, minlength=len(good))
    labels = good[owner]
    for final in (False, True):
        weights, transitions = crf.fit(
            x.shape[1], lambda w: (x @ w.astype(np.float32)).astype(float),
            lambda d: x.T @ d.astype(np.float32), lengths, labels, STEPS, RATE, DECAY)
        if not final:
            alone = 1 / (1 + np.exp(-np.clip(x @ weights, -crf.BOUND, crf.BOUND)))
            labels = np.where(alone >= CLEARLY_GOOD, 1, labels)
    p, _ = crf.marginals(x @ weights, lengths, transitions)
    weight = np.where(good == 1, 0.5 / good.mean(), 0.5 / (1 - good.mean()))
    return Model(weights, transitions,
                 *crf.calibrate(document_quality(p, n, owner, len(good)), good, weight))


SCHEMA = ("doc_id long, score double, predicted int, "
          "lines array<struct<start:long,end:long,good:double>>")


def score(documents: DataFrame, model: Model, carry: bool = False) -> DataFrame:
    """Quality of every whole text of ``documents`` (doc_id, text).

    Rows: doc_id, score (0 to 1), predicted (1 from 0.5 on) and lines: bytes [start, end) of each
    line with its probability to be good. A null or empty text is one empty line; a null doc_id
    stays null; repeated rows are scored each; other columns are not read unless ``carry``
    puts the whole row into the struct ``row``; an empty table gives no rows.
    """
    rows_in = texts_of(documents, carry)
    sent = documents.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("good", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in pieces(batches):
            for first, stop, data, bounds in T.slices(batch.column(1)):
                rows = stop - first
                x, size, owner = line_features(data, bounds)
                if known.slope or len(known.weights):
                    p, _ = crf.marginals(x @ known.weights, np.bincount(owner, minlength=rows),
                                         known.transitions)
                else:
                    p = np.full(len(owner), 0.5)
                z = known.slope * document_quality(p, size, owner, rows) + known.intercept
                result = 1 / (1 + np.exp(-np.clip(z, -crf.BOUND, crf.BOUND)))
                start, end, _ = lines(data, bounds)
                base = bounds[owner]
                found = pa.StructArray.from_arrays(
                    [pa.array(start - base), pa.array(end - base), pa.array(p)],
                    fields=list(kind))
                offsets = np.searchsorted(owner, np.arange(rows + 1)).astype(np.int32)
                columns = [batch.column(0).slice(first, rows), pa.array(result),
                     pa.array((result >= 0.5).astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(offsets), found)]
                names = ["doc_id", "score", "predicted", "lines"]
                if carry:
                    columns.append(batch.column(2).slice(first, rows))
                    names.append("row")
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows_in.mapInArrow(run, result_schema(rows_in, SCHEMA))


def classify(documents: DataFrame, labels: DataFrame, size: int = SAMPLE, by: int = 3,
             out: int = 1, carry: bool = False) -> DataFrame:
    """Scores of all ``documents``, learned outside the fold crc32(doc_id) mod ``by`` = ``out``."""
    model = fit(training_sample(documents, labels, "quality", size, by, out))
    return score(documents, model, carry).withColumn(
        "held_out", remainder(F.col("doc_id"), by) == out)
