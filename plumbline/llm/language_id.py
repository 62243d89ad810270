"""Language identification: unigram pieces of a fixed vocabulary, summed over all segmentations.

Each language has a probability for each piece of a public vocabulary. The probability of a word is
the sum over all ways to spell it with pieces, which a forward pass finds; a text has the product
over its words. Pieces never cross a word's bounds, so each distinct word is worked out once per
process. The probabilities are fitted by expectation maximisation on word counts of a bounded sample
of labelled texts: forward-backward gives expected piece counts in tasks, Spark sums them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import text as T
from plumbline.llm.tables import kept, pieces, remainder

#: Training bytes of each language in expectation; a language with fewer is used whole.
SAMPLE = 4 << 20
#: Rounds of expectation maximisation.
ROUNDS = 4
#: Share of a language's probability that is dealt evenly over all pieces.
SMOOTHING = 0.04
#: Languages at most, as the driver holds a probability for each piece and language.
LANGUAGES = 512
#: A longer word is spelled in stretches of at most so many bytes, cut between characters. The least
#: probability of a piece to this power must be a double.
STRETCH = 48
#: Words worked out at once.
BATCH = 1 << 15
UNKNOWN = "und"

#: Bytes of words: letters and all of beyond ASCII.
WORD = T.byte_class((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def vocabulary_pieces(path: str) -> list[bytes]:
    """Pieces of which lower-case words can consist, a space at the start for a word's begin, and all
    single bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {bytes([b]) for b in range(256)}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i).replace("▁", " ")
        body = piece.removeprefix(" ").encode()
        if body and piece == piece.lower() and WORD[np.frombuffer(body, np.uint8)].all():
            found.add(piece.encode())
    return sorted(found, key=lambda p: (len(p), p))


class Lattice:
    """All pieces at all places of words."""

    def __init__(self, vocabulary: list[bytes]) -> None:
        self.size = len(vocabulary)
        data = np.frombuffer(b"".join(vocabulary), np.uint8)
        length = np.array([len(p) for p in vocabulary])
        ends = np.cumsum(length)
        hashes = T.span_hash(T.prefix(data, T.EXACT), ends - length, ends)
        self.by_length = []
        for n in np.unique(length).tolist():
            own = np.flatnonzero(length == n)
            order = own[np.argsort(hashes[own])]
            self.by_length.append((n, hashes[order], order))

    def edges(self, data: np.ndarray, bounds: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(from node, to node, piece) in order of the target's place in its word. A word of n
        bytes has n + 1 nodes, numbered on through all words."""
        sums = T.prefix(data, T.EXACT)
        word = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        room = bounds[1:][word] - np.arange(len(data))
        start, size, piece = [], [], []
        for n, hashes, order in self.by_length:
            at = np.flatnonzero(room >= n)
            if not len(at):
                break
            h = T.span_hash(sums, at, at + n)
            place = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            hit = hashes[place] == h
            start.append(at[hit])
            size.append(np.full(int(hit.sum()), n))
            piece.append(order[place[hit]])
        at, n = np.concatenate(start), np.concatenate(size)
        begin = at + word[at]
        by = np.lexsort((begin + n, at + n - bounds[:-1][word[at]]))
        return begin[by], (begin + n)[by], np.concatenate(piece)[by]


def _sweep(value: np.ndarray, source: np.ndarray, target: np.ndarray, weight: np.ndarray,
           step: np.ndarray) -> None:
    """Sum into each target what its sources hold, level by level; targets of a level are sorted."""
    cuts = np.flatnonzero(np.r_[True, step[1:] != step[:-1], True])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        to = target[a:b]
        first = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
        value[to[first]] = np.add.reduceat(value[source[a:b]] * weight[a:b], first, axis=0)


def forward(lattice: Lattice, data: np.ndarray, bounds: np.ndarray, table: np.ndarray
            ) -> np.ndarray:
    """Log probability of each word in each language, summed over all its segmentations.

    ``table`` holds pieces by languages.
    """
    out = np.zeros((len(bounds) - 1, table.shape[1]))
    for low in range(0, len(out), BATCH):
        some = bounds[low:low + BATCH + 1]
        base = some - some[0]
        begin, end, piece = lattice.edges(data[some[0]:some[-1]], base)
        heads = base[:-1] + np.arange(len(base) - 1)
        value = np.zeros((base[-1] + len(base) - 1, table.shape[1]))
        value[heads] = 1.0
        depth = np.arange(len(value)) - np.repeat(heads, np.diff(base) + 1)
        _sweep(value, begin, end, table[piece], depth[end])
        out[low:low + BATCH] = np.log(value[heads + np.diff(base)])
    return out


def expected(lattice: Lattice, data: np.ndarray, bounds: np.ndarray, count: np.ndarray,
             chance: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in one language's words, each ``count`` times."""
    total = np.zeros(lattice.size)
    for low in range(0, len(bounds) - 1, BATCH):
        some = bounds[low:low + BATCH + 1]
        base = some - some[0]
        begin, end, piece = lattice.edges(data[some[0]:some[-1]], base)
        words = len(base) - 1
        heads = base[:-1] + np.arange(words)
        tails = heads + np.diff(base)
        depth = np.arange(int(base[-1]) + words) - np.repeat(heads, np.diff(base) + 1)
        weight = chance[piece]
        ahead, back = np.zeros(len(depth)), np.zeros(len(depth))
        ahead[heads] = back[tails] = 1.0
        _sweep(ahead, begin, end, weight, depth[end])
        left = np.repeat(np.diff(base), np.diff(base) + 1) - depth
        by = np.lexsort((begin, left[begin]))
        _sweep(back, end[by], begin[by], weight[by], left[begin[by]])
        owner = np.repeat(np.arange(words), np.diff(base) + 1)
        word = owner[begin]
        share = ahead[begin] * weight * back[end] / ahead[tails][word] * count[low:low + BATCH][word]
        total += np.bincount(piece, weights=share, minlength=lattice.size)
    return total


def spelled(data: np.ndarray, start: np.ndarray, end: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and bounds of the stretches of all words, the first of each with a space before it,
    and the word of each stretch."""
    word = np.arange(len(start))
    lead = np.ones(len(start), np.int64)
    long = np.flatnonzero(end - start > STRETCH)
    if len(long):
        spans = [(a, b, w, 1) for a, b, w in zip(start.tolist(), end.tolist(), word.tolist(),
                                                 strict=True) if b - a <= STRETCH]
        for w in long.tolist():
            at, stop, opens = int(start[w]), int(end[w]), 1
            while at < stop:
                to = min(at + STRETCH, stop)
                while to < stop and to > at + 1 and data[to] & 0xC0 == 0x80:
                    to -= 1
                spans.append((at, to, w, opens))
                at, opens = to, 0
        start, end, word, lead = (np.array(x, np.int64) for x in zip(*spans, strict=True))
    size = end - start + lead
    bounds = np.r_[0, np.cumsum(size)]
    flat = np.full(int(bounds[-1]), 0x20, np.uint8)
    flat[T.spread(bounds[:-1] + lead, end - start)] = data[T.spread(start, end - start)]
    return flat, bounds, word


def lower_parts(texts: pa.Array) -> Iterator[tuple]:
    """``text.parts`` of the texts in lower case, long ones cut outside words."""
    yield from T.parts(pc.utf8_lower(texts), T.BREAK)


def distinct(data: np.ndarray, start: np.ndarray, end: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of each word's kind, the hash of each kind, and a word of each kind."""
    code, keys = pd.factorize(T.span_hash(T.prefix(data, T.EXACT), start, end))
    first = np.zeros(len(keys), np.int64)
    first[code[::-1]] = np.arange(len(code))[::-1]
    return code, keys, first


@dataclass
class Model:
    """Pieces, languages in order, log priors, and a probability for each piece and language."""

    pieces: list[bytes]
    languages: list[str]
    prior: np.ndarray
    table: np.ndarray


def sample_words(labelled: DataFrame, languages: list[str], share: dict[str, float]) -> DataFrame:
    """(lang, word, n) of a random share of each language's rows; lang is the place in the list."""
    dice = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / (1 << 30)
    place = {name: k for k, name in enumerate(languages)}
    chance = F.element_at(F.create_map(*[F.lit(x) for pair in share.items() for x in pair]),
                          F.col("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            lang = np.array([place[x] for x in batch.column(0).to_pylist()])
            for rows, data, bounds, _, _ in lower_parts(batch.column(1)):
                start, end, text = T.words(data, bounds, WORD)
                own = lang[rows][text]
                for k in np.unique(own).tolist():
                    at, to = start[own == k], end[own == k]
                    code, keys, first = distinct(data, at, to)
                    n = np.bincount(code, minlength=len(keys)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(n), k, np.int32)),
                         T.taken(data, at[first], to[first]), pa.array(n)], ["lang", "word", "n"])

    return labelled.where(dice < chance).select("lang", "text").mapInArrow(
        run, "lang int, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame, vocabulary: list[bytes], sample: int = SAMPLE, rounds: int = ROUNDS
        ) -> Model:
    """A model of rows (doc_id, text, lang).

    The sample takes about ``sample`` bytes of each language; a row's place in it follows from its
    doc_id and text alone. The driver holds one number for each piece and language.
    """
    seen = labelled.where("lang is not null and text is not null").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).orderBy(
            "lang").limit(LANGUAGES + 1).collect()
    if len(seen) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    languages = [r.lang for r in seen]
    prior = np.log(np.array([float(r.n) for r in seen]) / max(1, sum(r.n for r in seen)))
    lattice = Lattice(vocabulary)
    table = np.full((lattice.size, len(languages)), 1 / lattice.size)
    if not languages:
        return Model(vocabulary, languages, prior, table)
    share = {r.lang: min(1.0, sample / max(1, r.bytes)) for r in seen}
    words = kept(sample_words(labelled.where("lang is not null and text is not null"), languages,
                              share), "language-words")
    for _ in range(rounds):
        def run(batches: Iterator[pa.RecordBatch], table: np.ndarray = table
                ) -> Iterator[pa.RecordBatch]:
            own, total = Lattice(vocabulary), {}
            for batch in pieces(batches):
                lang = batch.column(0).to_numpy()
                count = batch.column(2).to_numpy()
                data, bounds = T.utf8(batch.column(1))
                for k in np.unique(lang).tolist():
                    at = np.flatnonzero(lang == k)
                    flat, cuts, word = spelled(data, bounds[:-1][at], bounds[1:][at])
                    total[k] = total.get(k, 0) + expected(own, flat, cuts, count[at][word],
                                                          table[:, k])
            for k, use in total.items():
                # Fixed point, so that sums do not depend on their order.
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(use), k, np.int32)), pa.array(np.arange(len(use))),
                     pa.array(np.round(use * 4096).astype(np.int64))], ["lang", "piece", "uses"])

        uses = np.zeros(table.shape)
        for r in words.mapInArrow(run, "lang int, piece long, uses long").where("uses > 0").groupBy(
                "lang", "piece").agg(F.sum("uses").alias("uses")).collect():
            uses[r.piece, r.lang] = r.uses
        total = np.maximum(uses.sum(axis=0), 1)
        table = (1 - SMOOTHING) * uses / total + SMOOTHING / lattice.size
        table /= table.sum(axis=0)
    return Model(vocabulary, languages, prior, table)


class Scorer:
    """Log probabilities of texts; distinct words are kept while there is room."""

    def __init__(self, model: Model) -> None:
        self.model, self.lattice = model, Lattice(model.pieces)
        self.memo = T.Memo()
        self.known = np.zeros((0, len(model.languages)))

    def words(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of each word."""
        code, keys, first = distinct(data, start, end)
        new = self.memo.missing(keys, 100 + 8 * self.known.shape[1])
        if not self.memo.slot:
            self.known = self.known[:0]
        if len(new):
            flat, bounds, word = spelled(data, start[first[new]], end[first[new]])
            value = forward(self.lattice, flat, bounds, self.model.table)
            total = np.zeros((len(new), value.shape[1]))
            np.add.at(total, word, value)
            self.known = np.concatenate([self.known, total])
            self.memo.add(keys[new])
        return self.known[self.memo.slots(keys)][code]

    def texts(self, array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Log probability by text and language, and which texts have a letter."""
        value = np.zeros((len(array), len(self.model.languages)))
        letters = np.zeros(len(array), bool)
        for rows, data, bounds, _, _ in lower_parts(array):
            start, end, text = T.words(data, bounds, WORD)
            if not len(start):
                continue
            each = self.words(data, start, end)
            for k in range(value.shape[1]):
                value[rows, k] += np.bincount(text, weights=each[:, k], minlength=len(rows))
            plain = np.r_[0, np.cumsum((data >= 97) & (data <= 122))]
            letters[rows] |= plain[bounds[1:]] > plain[bounds[:-1]]
            for i in np.unique(text[~letters[rows][text]]).tolist():
                letters[rows[i]] = any(
                    c.isalpha() for c in data[bounds[i]:bounds[i + 1]].tobytes().decode())
        return value, letters


def posterior(value: np.ndarray, prior: np.ndarray) -> np.ndarray:
    value = value + prior
    value = np.exp(value - value.max(axis=1, keepdims=True))
    return value / value.sum(axis=1, keepdims=True)


def identify(documents: DataFrame, path: str, held_out: int = 2, folds: int = 4,
             sample: int = SAMPLE, rounds: int = ROUNDS) -> DataFrame:
    """The language of every whole text of ``documents`` (doc_id, text, lang).

    Learns from rows with a text and a lang whose crc32 of the id modulo ``folds`` is not
    ``held_out``. Rows: doc_id, held_out, lang_pred, score (its posterior probability), and
    ``languages``, the log probability of the text by language. A text that is null or has no letter
    is ``und`` with score 0 and no languages, as is every text if nothing could be learned; a null
    doc_id counts as the empty text in the crc; languages of equal probability go by name; repeated
    rows give repeated results; other columns are not read; an empty table gives no rows.
    """
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                            F.col("lang").cast("string"))
    fold = remainder(F.col("doc_id"), folds)
    model = fit(rows.where(fold != held_out), vocabulary_pieces(path), sample, rounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        names = pa.array(model.languages, pa.string())
        kind = pa.map_(pa.string(), pa.float64())
        for batch in pieces(batches):
            value, letters = scorer.texts(batch.column(2))
            if not model.languages:
                letters[:] = False
            best, score = np.zeros(len(letters), np.int64), np.zeros(len(letters))
            if letters.any():
                chance = posterior(value[letters], model.prior)
                best[letters] = chance.argmax(axis=1)
                score[letters] = chance.max(axis=1)
            lang = [model.languages[k] if ok else UNKNOWN
                    for k, ok in zip(best.tolist(), letters.tolist(), strict=True)]
            size = np.where(letters, len(names), 0)
            known = np.flatnonzero(letters)
            maps = pa.MapArray.from_arrays(
                pa.array(np.r_[0, np.cumsum(size)].astype(np.int32)),
                names.take(pa.array(np.tile(np.arange(len(names)), len(known)))),
                pa.array(value[known].ravel())).cast(kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score),
                 maps], ["doc_id", "held_out", "lang_pred", "score", "languages"])

    return rows.select("doc_id", (fold == held_out).alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double, "
             "languages map<string,double>")
