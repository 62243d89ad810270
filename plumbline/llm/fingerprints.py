"""Document fingerprints by I-Match with randomised lexicons.

The lexicon holds the terms whose document frequency, counted over all documents, lies in a band:
``LOW_SHARE`` to ``HIGH_SHARE`` of the documents. A fingerprint hashes a document's distinct terms,
sorted, within several random subsets of the lexicon. Subsets come in levels of halving density; a
document uses the levels from the one at which a subset holds about half a term of it, so that a
subset survives an edit with a fair chance for short and long texts alike. Two fingerprints are as like
as the share of subsets that hold terms of either and hash equal, over the levels both have.

A lexicon term occurs in ``LOW_SHARE`` of all documents, so the lexicon has at most (mean distinct
terms of a document) / LOW_SHARE terms, whatever the number of documents: that bounds the
broadcast.

To compare each document with an edited copy that ends like the beginning of the next one, texts
are dealt once, compressed, into sorted ranges of doc_id, and each range is read as a stream that
holds some MB. The last document of a range meets the first one of the next range by a join, after
all others are written. The driver receives nothing but the lexicon.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm import text as T
from plumbline.llm.tables import kept, pieces

#: Shares of all documents that bound the lexicon's document frequencies.
LOW_SHARE, HIGH_SHARE = 0.0005, 0.02
#: Random subsets of each level, levels of a document, and terms its densest should hold.
SUBSETS, LEVELS, TERMS = 16, 4, 0.5
#: Bytes of text that a task compares at once.
RANGE_BYTES = 8 << 20
#: Characters of a text that order rows of the same id, before a hash of the whole text does.
HEAD = 32
#: Pairs of term and count that a counting task holds before it hands them on.
HELD = 1 << 20

SEEDS = T.mix(np.arange(1, SUBSETS + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))


def distinct_terms(data: np.ndarray, bounds: np.ndarray, lexicon: np.ndarray | None = None
                   ) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of each distinct term of each text, in that order."""
    hashes, text = T.word_hashes(data, bounds, T.ALNUM, T.FOLDED)
    if lexicon is not None:
        inside = contained(lexicon, hashes)
        hashes, text = hashes[inside], text[inside]
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return text[fresh], hashes[fresh]


def contained(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values


def document_frequencies(texts: DataFrame) -> DataFrame:
    """(term, df) of every term of all texts; summed in each task before anything is shuffled."""
    def emit(terms: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(terms.view(np.int64)), pa.array(counts)], ["term", "df"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in pieces(batches):
            for _, _, data, bounds in T.slices(batch.column(0)):
                _, found = distinct_terms(data, bounds)
                keys, back = np.unique(np.r_[terms, found], return_inverse=True)
                weights = np.r_[counts, np.ones(len(found), np.int64)]
                terms = keys
                counts = np.bincount(back, weights=weights).astype(np.int64)
                if len(terms) > HELD:
                    yield emit(terms, counts)
                    terms, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if len(terms):
            yield emit(terms, counts)

    return texts.mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def lexicon(documents: DataFrame, low: float = LOW_SHARE, high: float = HIGH_SHARE) -> np.ndarray:
    """Sorted hashes of the terms in the band. At most mean distinct terms / ``low`` of them."""
    rows = documents.count()
    band = document_frequencies(documents.select(F.col("text").cast("string"))).where(
        F.col("df").between(low * rows, max(1.0, high * rows))).select("term").toArrow()
    return np.sort(band["term"].to_numpy().view(np.uint64))


@dataclass
class Prints:
    """Fingerprints of several texts: kind, level and a row of hashes each (0: no term)."""

    kind: np.ndarray
    level: np.ndarray
    hashes: np.ndarray

    def text(self, i: int) -> str:
        return f"{'bac'[self.kind[i]]}{self.level[i]}:" + self.hashes[i].astype(">u4").tobytes().hex()

    def likeness(self, i: np.ndarray, other: "Prints", j: np.ndarray) -> np.ndarray:
        """Share of subsets in use that hash equal, over the common levels; 1 if all is equal."""
        a, b = self.hashes[i], other.hashes[j]
        same_kind = self.kind[i] == other.kind[j]
        matched, used = np.zeros(len(i)), np.zeros(len(i))
        for x in range(LEVELS):
            for y in range(LEVELS):
                common = same_kind & (self.level[i] + x == other.level[j] + y)
                p = a[:, x * SUBSETS:(x + 1) * SUBSETS]
                q = b[:, y * SUBSETS:(y + 1) * SUBSETS]
                some = ((p != 0) | (q != 0)) & common[:, None]
                used += some.sum(1)
                matched += (some & (p == q)).sum(1)
        whole = same_kind & (self.level[i] == other.level[j]) & (a == b).all(1)
        return np.where(whole, 1.0, matched / np.maximum(used, 1))


def fingerprints(array, words: np.ndarray) -> Prints:
    """Of an Arrow text array. A text without lexicon terms uses all its terms; one without any
    terms has a digest of its bytes in place of every hash."""
    n = len(array)
    kind, level = np.full(n, 2, np.int64), np.zeros(n, np.int64)
    hashes = np.zeros((n, LEVELS * SUBSETS), np.uint32)
    for first, end, data, bounds in T.slices(array):
        rows = end - first
        text, term = distinct_terms(data, bounds, words)
        bare = np.bincount(text, minlength=rows) == 0
        own_kind = np.where(bare, 1, 0)
        if bare.any():
            # distinct_terms again for these texts alone, without the lexicon
            keep = np.repeat(bare, np.diff(bounds))
            part = np.r_[0, np.cumsum(np.where(bare, np.diff(bounds), 0))]
            more_text, more_term = distinct_terms(data[keep], part)
            text, term = np.r_[text, more_text], np.r_[term, more_term]
            order = np.argsort(text, kind="stable")
            text, term = text[order], term[order]
        count = np.bincount(text, minlength=rows)
        at = np.maximum(1, np.floor(np.log2(np.maximum(count, 1) / TERMS))).astype(np.int64)
        heads = np.flatnonzero(np.r_[True, text[1:] != text[:-1]]) if len(text) else text
        owner = text[heads]
        value = T.mix(term ^ np.uint64(0x2545F4914F6CDD1D))
        for s, seed in enumerate(SEEDS):
            draw = T.mix(term + seed)
            for x in range(LEVELS):
                shift = (at[text] + x).astype(np.uint64)
                inside = draw >> (np.uint64(64) - shift) == 0
                if len(heads):
                    total = T.mix(np.add.reduceat(np.where(inside, value, np.uint64(0)), heads))
                    empty = np.add.reduceat(inside.astype(np.int64), heads) == 0
                    found = np.maximum((total >> np.uint64(32)).astype(np.uint32), 1)
                    hashes[first + owner, x * SUBSETS + s] = np.where(empty, 0, found)
        none = count == 0
        for i in np.flatnonzero(none).tolist():
            digest = hashlib.sha256(data[bounds[i]:bounds[i + 1]].tobytes()).digest()
            hashes[first + i] = np.frombuffer(digest[:4] * (LEVELS * SUBSETS), np.uint32) | 1
        kind[first:end] = np.where(none, 2, own_kind)
        level[first:end] = np.where(none, 0, at)
    return Prints(kind, level, hashes)


PRINTED = "doc_id long, fingerprint string"


def fingerprint(documents: DataFrame, words: np.ndarray | None = None) -> DataFrame:
    """(doc_id, fingerprint) of every whole text; equal texts have equal fingerprints.

    A null text counts as empty; a null doc_id stays null; repeated rows have a fingerprint each;
    other columns are not read; an empty table gives no rows.
    """
    sent = documents.sparkSession.sparkContext.broadcast(
        lexicon(documents) if words is None else words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = fingerprints(batch.column(1), sent.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([found.text(i) for i in range(batch.num_rows)])],
                ["doc_id", "fingerprint"])

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")
                            ).mapInArrow(run, PRINTED)


COMPARED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
            "edited_fingerprint string, near_edited double, near_next double")
#: Rows of a range: compared ones, and its first and last document, with their texts.
STREAMED = COMPARED + ", part int, edge string, text string"


def in_ranges(documents: DataFrame) -> DataFrame:
    """(doc_id, size, data) in sorted ranges of doc_id; data is the compressed text.

    Null ids come first. Rows of one id follow in order of the first ``HEAD`` characters of their
    texts, then of a hash of them, so that ranges can divide them; only copies are dealt by chance.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            raw = [x.as_buffer() for x in batch.column(3)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([b.size for b in raw], pa.int64()),
                 pa.array([pa.compress(b, "zstd", asbytes=True) for b in raw], pa.binary())],
                ["doc_id", "head", "mark", "size", "data"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.substring(text, 1, HEAD).alias("head"),
                            F.xxhash64(text).alias("mark"), text.alias("text"))
    order = ["doc_id", "head", "mark"]
    packed = rows.mapInArrow(pack, "doc_id long, head string, mark long, size long, data binary")
    return packed.repartitionByRange(*order, F.rand(17)).sortWithinPartitions(*order).select(
        "doc_id", "size", "data")


def compared(ids: list, own: list[str], words: np.ndarray, part: int) -> pa.RecordBatch:
    """Rows of ``COMPARED`` for the ids; their texts, and after them the one that follows, are given."""
    edited, size = [], []
    for text, after in zip(own, own[1:], strict=False):
        cut = len(text) // part
        edited.append(text[:len(text) - cut] + after[:cut])
        size.append(len(text))
    prints = fingerprints(pa.array(own, pa.large_string()), words)
    others = fingerprints(pa.array(edited, pa.large_string()), words)
    at = np.arange(len(ids))
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array(ids, pa.int64()),
        "n_chars": pa.array(size, pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited],
                                  pa.string()),
        "fingerprint": pa.array([prints.text(i) for i in at], pa.string()),
        "edited_fingerprint": pa.array([others.text(i) for i in at], pa.string()),
        "near_edited": pa.array(prints.likeness(at, others, at)),
        "near_next": pa.array(prints.likeness(at, prints, at + 1))})


def compare_edited(documents: DataFrame, part: int = 4) -> DataFrame:
    """Fingerprints of every text and of its edited copy, and how like they are.

    The edited copy has the last n_chars // ``part`` code points replaced by the first as many, or
    all, of the next document in order of doc_id (after the last: the first). A null text counts
    as empty; null ids come first; rows of the same id are ordered as in :func:`in_ranges`; other
    columns are not read; an empty table gives no rows; a single row is its own next. The result
    is written to the shared folder once.
    """
    words = documents.sparkSession.sparkContext.broadcast(lexicon(documents))
    limit = RANGE_BYTES

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, first, ids, texts, held = TaskContext.get().partitionId(), None, [], [], 0

        def flush() -> pa.RecordBatch:
            done = compared(ids[:-1], texts, words.value, part)
            n = done.num_rows
            return pa.RecordBatch.from_arrays(
                [*done.columns, pa.array([number] * n, pa.int32()), pa.nulls(n, pa.string()),
                 pa.nulls(n, pa.string())], [*done.schema.names, "part", "edge", "text"])

        def edge(name: str, i: int | None, text: str) -> pa.RecordBatch:
            none = {c: pa.nulls(1, t) for c, t in (
                ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                ("near_edited", pa.float64()), ("near_next", pa.float64()))}
            return pa.RecordBatch.from_pydict({
                "doc_id": pa.array([i], pa.int64()), **none, "part": pa.array([number], pa.int32()),
                "edge": pa.array([name]), "text": pa.array([text], pa.string())})

        for batch in pieces(batches):
            for i, n, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                  batch.column(2), strict=True):
                ids.append(i)
                texts.append(pa.decompress(data.as_buffer(), n, "zstd", asbytes=True).decode()
                             if n else "")
                if first is None:
                    first = i, texts[0]
                    yield edge("first", *first)
                held += n
                if held > limit and len(ids) > 1:
                    yield flush()
                    del ids[:-1], texts[:-1]
                    held = n
        if len(ids) > 1:
            yield flush()
        if ids:
            yield edge("last", ids[-1], texts[-1])

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            for i, text, after in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                yield compared([i], [text, after], words.value, part)

    rows = kept(in_ranges(documents).mapInArrow(stream, STREAMED), "fingerprints")
    names = [c.split()[0] for c in COMPARED.split(", ")]
    heads = rows.where("edge = 'first'").select(F.col("part").alias("next"), F.col("text").alias("after"))
    tails = rows.where("edge = 'last'").select("part", "doc_id", "text")
    # One row for each range, without its texts: the next range that has rows, at the end the first.
    w = Window.orderBy("part")
    places = rows.where("edge = 'first'").select("part").select("part", F.coalesce(
        F.lead("part").over(w), F.first("part").over(w)).alias("next"))
    last = tails.join(places, "part").join(heads, "next").select("doc_id", "text", "after")
    return rows.where("edge IS NULL").select(*names).unionAll(last.mapInArrow(ends, COMPARED))
