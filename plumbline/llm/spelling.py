"""Spelling variants: one-edit neighbours of words through a reduced alphabet.

Words are counted in tasks and summed by Spark. Each letter is mapped to one of a few symbols, so
that words become reduced words; two words that differ by one edit have reduced words that are equal
or differ by one edit. The full one-edit neighbourhood of every distinct reduced word is generated
as hashes, each in constant time from prefix sums, and joined with the reduced vocabulary. The words
behind each hit are compared in full. The alphabet grows with the sixth root of the vocabulary, so
that the expected number of words behind a reduced word stays the same at any size.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm import text as T
from plumbline.llm.tables import kept, pieces

#: Fixed values of the word rule: least code points and occurrences of a word, one run in
#: ``DROP`` loses a letter, and a form is ``RATIO`` times as frequent as its variant.
LENGTH, TIMES, DROP, RATIO = 6, 5, 199, 5

#: Letters as Latin-1 bytes: a-z and U+00C0 to U+00FF.
LETTERS = np.r_[97:123, 0xC0:0x100]
#: Symbols of the reduced alphabet for each sixth root of the vocabulary.
SYMBOLS = 0.75
#: Neighbours made at once.
BLOCK = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _crc_table() -> np.ndarray:
    """CRC-32 of one byte, by its reflected polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


CRC = _crc_table()


def runs(data: np.ndarray, bounds: np.ndarray
         ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, text and code points of each maximal run of ``[A-Za-z\\u00C0-\\u00FF]``.

    The letters beyond ASCII are exactly those whose UTF-8 form begins with the byte C3.
    """
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    lead = data == 0xC3
    inside = ((data | 32) >= 97) & ((data | 32) <= 122) | lead
    inside[1:] |= lead[:-1]
    cut = np.zeros(n + 1, bool)
    cut[bounds] = True
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | cut[1:n]
    closes[:-1] &= ~inside[1:] | cut[1:n]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    wide = np.zeros(n + 1, np.int64)
    np.cumsum(lead, out=wide[1:])
    points = end - start - (wide[end] - wide[start])
    return start, end, np.searchsorted(bounds, start, "right") - 1, points


def crcs(data: np.ndarray, start: np.ndarray, end: np.ndarray, state: np.ndarray) -> np.ndarray:
    """CRC-32 of what gave each ``state``, followed by the bytes of each span."""
    length = end - start
    by = np.argsort(-length, kind="stable")
    value, at = ~state[by].astype(np.uint32), start[by]
    reach = np.searchsorted(-length[by], -np.arange(1, int(length.max(initial=0)) + 1), "right")
    for step, many in enumerate(reach.tolist()):
        v = value[:many]
        value[:many] = CRC[(v ^ data[at[:many] + step]) & 255] ^ (v >> np.uint32(8))
    out = np.empty(len(by), np.uint32)
    out[by] = ~value
    return out


def counted(documents: DataFrame, length: int = LENGTH, drop: int = DROP) -> DataFrame:
    """(word, n) of each part of the input; the caller sums them."""
    folded = np.arange(256, dtype=np.uint8)
    folded[65:91] += 32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            ids = batch.column(0).to_pylist()
            for rows, raw, bounds, _, _ in T.parts(batch.column(1), T.BREAK, size=4 * T.SLICE):
                data = folded[raw]
                start, end, text, points = runs(data, bounds)
                long = points >= length
                start, end, text = start[long], end[long], text[long]
                if not len(start):
                    continue
                heads = np.array([zlib.crc32(
                    f"{'' if ids[r] is None else ids[r]}:".encode()) for r in rows], np.uint32)
                value = crcs(data, start, end, heads[text])
                hit = value % np.uint32(drop) == 0
                edited: Counter[str] = Counter()
                for a, b, h in zip(start[hit].tolist(), end[hit].tolist(), value[hit].tolist(),
                                   strict=True):
                    word = data[a:b].tobytes().decode()
                    at = h % len(word)
                    if len(word) > length:
                        edited[word[:at] + word[at + 1:]] += 1
                start, end = start[~hit], end[~hit]
                code, keys = pd.factorize(T.span_hash(T.prefix(data, T.EXACT), start, end))
                first = np.zeros(len(keys), np.int64)
                first[code[::-1]] = np.arange(len(code))[::-1]
                words = T.taken(data, start[first], end[first])
                n = np.bincount(code, minlength=len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([words, pa.array(n)], ["word", "n"])
                if edited:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(edited), pa.string()),
                         pa.array(list(edited.values()), pa.int64())], ["word", "n"])

    rows = documents.select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "word string, n long")


def vocabulary(documents: DataFrame, length: int = LENGTH, times: int = TIMES, drop: int = DROP
               ) -> DataFrame:
    """(word, n) of all words with at least ``times`` occurrences, written to the shared folder."""
    return kept(counted(documents, length, drop).groupBy("word").agg(F.sum("n").alias("n")).where(
        F.col("n") >= times), "spelling-words")


def latin(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One byte for each letter of all words in a row, and the bounds between the words."""
    data, bounds = T.utf8(words)
    lead = data == 0xC3
    wide = np.zeros(len(data) + 1, np.int64)
    np.cumsum(lead, out=wide[1:])
    follows = np.r_[False, lead[:-1]][:len(data)]
    return np.where(follows, data | 0xC0, data)[~lead], bounds - wide[bounds]


def reduced_alphabet(words: DataFrame, symbols: float = SYMBOLS) -> np.ndarray:
    """A symbol for each Latin-1 byte; letters are dealt so that symbols are about equally common.

    The number of symbols is ``symbols`` times the sixth root of the number of words, at least 2.
    The driver gets a count for each letter.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(256, np.int64), 0
        for batch in pieces(batches):
            total += np.bincount(latin(batch.column(0))[0], minlength=256)
            n += batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[LETTERS, -1]), pa.array(np.r_[total[LETTERS], n])], ["letter", "n"])

    seen = {r.letter: r.n for r in words.select("word").mapInArrow(run, "letter long, n long")
            .groupBy("letter").agg(F.sum("n").alias("n")).collect()}
    size = max(2, min(len(LETTERS), math.ceil(symbols * seen.get(-1, 0) ** (1 / LENGTH))))
    load, symbol = [0] * size, np.zeros(256, np.uint8)
    for letter in sorted(LETTERS.tolist(), key=lambda x: (-seen.get(x, 0), x)):
        least = min(range(size), key=lambda s: (load[s], s))
        symbol[letter] = least
        load[least] += seen.get(letter, 0) + 1
    return symbol


def _powers(n: int) -> np.ndarray:
    run = np.full(n, _BASE, np.uint64)
    run[:1] = 1
    return np.multiply.accumulate(run)


def _keys(value: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    return T.mix(value + np.asarray(length).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def reduced_keys(words: pa.Array, symbol: np.ndarray) -> np.ndarray:
    """The hash of each word's reduced word."""
    letters, bounds = latin(words)
    value = T.mix(np.arange(1, 257, dtype=np.uint64))[symbol[letters]]
    length = np.diff(bounds)
    place = np.arange(len(letters)) - np.repeat(bounds[:-1], length)
    sums = np.zeros(len(letters) + 1, np.uint64)
    np.cumsum(value * _powers(int(length.max(initial=0)) + 1)[place], out=sums[1:])
    return _keys(sums[bounds[1:]] - sums[bounds[:-1]], length).view(np.int64)


def neighbourhoods(words: pa.Array, symbol: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(key of a neighbour, key of the reduced word) for the full one-edit neighbourhood of each
    reduced word: itself, deletions, replacements and insertions, each distinct string once for
    its kind of edit."""
    letters, bounds = latin(words)
    own = reduced_keys(words, symbol)
    size = int(symbol.max()) + 1
    value = T.mix(np.arange(1, 257, dtype=np.uint64))
    length = np.diff(bounds)
    for many in np.unique(length).tolist():
        at = np.flatnonzero(length == many)
        power = _powers(many + 1)
        step = max(1, BLOCK // ((many + 1) * size))
        for low in range(0, len(at), step):
            some = at[low:low + step]
            reduced = symbol[letters[bounds[some][:, None] + np.arange(many)]]
            sums = np.zeros((len(some), many + 1), np.uint64)
            np.cumsum(value[reduced] * power[:many], axis=1, out=sums[:, 1:])
            whole, key = sums[:, -1:], own[some][:, None]
            same = np.zeros((len(some), many + 1), bool)  # equal to the symbol before
            same[:, 1:-1] = reduced[:, 1:] == reduced[:, :-1]
            yield own[some], own[some]
            gone = sums[:, :-1] + (whole - sums[:, 1:]) * _BACK
            ok = ~same[:, :-1]
            yield (_keys(gone, many - 1).view(np.int64)[ok], np.broadcast_to(key, ok.shape)[ok])
            for a in range(size):
                ok = reduced != a
                put = whole + (value[a] - value[reduced]) * power[:many]
                yield (_keys(put, many).view(np.int64)[ok], np.broadcast_to(key, ok.shape)[ok])
                ok = np.ones((len(some), many + 1), bool)
                ok[:, 1:] = reduced != a  # else the string is that of the place before
                put = sums + value[a] * power + (whole - sums) * _BASE
                yield (_keys(put, many + 1).view(np.int64)[ok],
                       np.broadcast_to(key, ok.shape)[ok])


def near_words(words: DataFrame, symbol: np.ndarray) -> DataFrame:
    """(word, near, near_n): all ordered pairs of words that differ by exactly one inserted, deleted
    or replaced letter."""
    def with_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array(reduced_keys(batch.column(0), symbol))], ["word", "n", "key"])

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            for near, own in neighbourhoods(batch.column(0), symbol):
                for low in range(0, len(near), BLOCK):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(near[low:low + BLOCK]), pa.array(own[low:low + BLOCK])],
                        ["key", "own"])

    listed = kept(words.mapInArrow(with_key, "word string, n long, key long"), "spelling-keys")
    # One word stands for all that have its reduced word.
    reduced = listed.groupBy("key").agg(F.min("word").alias("word")).select("word")
    hits = reduced.mapInArrow(around, "key long, own long").join(
        listed.select("key", F.col("word").alias("near"), F.col("n").alias("near_n")), "key")
    return hits.select(F.col("own").alias("key"), "near", "near_n").join(
        listed.select("key", "word"), "key").where(
        F.levenshtein("word", "near", 1) == 1).select("word", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of each row of (word, form), by pointer doubling; forms lead to no cycle.

    Each round is written to the shared folder. A chain of forms grows in occurrences by a fixed
    ratio, so there are as many rounds as the logarithm of a logarithm of the largest count.
    """
    at = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = kept(at.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if at.where("moved").isEmpty():
            return at.select("word", "root")
        at = at.select("word", "root")


def group_variants(documents: DataFrame, length: int = LENGTH, times: int = TIMES,
                   drop: int = DROP, ratio: int = RATIO, symbols: float = SYMBOLS) -> DataFrame:
    """Every word of ``documents`` (doc_id, text) with its near words and the form it varies.

    Rows: word, form, root, n, n_near, form_n. Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``,
    A-Z in lower case; a run whose crc32 with the doc_id is divisible by ``drop`` loses one letter.
    Those of at least ``length`` code points and ``times`` occurrences count. The form is the near
    word with the largest n, of equals the first in code-point order, if it has ``ratio`` times
    the word's n; the root ends the chain of forms. A null text has no words; a null doc_id counts
    as the empty text in the crc; repeated rows count each; other columns are not read; an empty
    table gives no rows. Texts and words may be of any length: a long text is read in parts, and
    the neighbours of a word are hashes of constant size.
    """
    words = vocabulary(documents, length, times, drop)
    near = near_words(words, reduced_alphabet(words, symbols))
    best: Column = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    found = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    leads = -F.col("best.less") >= ratio * F.col("n")
    lines = kept(words.join(found, "word", "left").select(
        "word", F.when(leads, F.col("best.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(leads, -F.col("best.less")).alias("form_n")), "spelling-forms")
    ends = roots(lines.where("form is not null"))
    return lines.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
