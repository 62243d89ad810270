"""Removal of byte strings that occur in an earlier document, by merged Burrows-Wheeler transforms.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts in a document with
a smaller doc_id.

Candidates. Every window of LENGTH bytes has a minimizer: its least-hashed ``GRAM``-byte string.
Equal windows have equal minimizers, so it is enough to compare the contexts of equal anchors; a
context is all bytes that a window around its anchor can reach. Tasks send the anchors of their
texts (two hashes and a place), dealt by anchor; texts stay. Equal contexts are settled at once:
all but the earliest document lose the whole context. Within a task this happens before anything is
sent, so a passage in a third of all documents arrives once per sending task.

Comparison. Where an anchor has several different contexts, the earliest document of each sends it in
two halves, each dealt by the bytes that all its windows share; halves that no other document has are
left out. An anchor with more than ``HOT`` contexts, as of a frequent line in ever new surroundings,
would bring them all to one task: instead each of its windows is dealt by 128 bits of its own hash,
and tasks hand on the least document of each. A task cuts contexts into shards, builds the transform
of each shard, and merges the transforms by refining their interleave: each round sorts the interleave stably by the symbol
that precedes each suffix, which orders it by one symbol more, and splits the blocks of suffixes
that agree so far. No suffix is sorted again. After LENGTH rounds a block is an interval whose
common prefix has at least LENGTH bytes, that is a repeated string, and the least document in it
decides which of its occurrences go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import text as T
from plumbline.llm.tables import kept, pieces, quoted, result_schema

LENGTH = 50
#: Bytes of an anchor. Shorter ones are fewer, but meet by chance more often.
GRAM = 24
#: Bytes of text whose anchors a task holds, of text per anchor group, of contexts per group, and
#: of a shard.
HELD, GROUP, MERGED, SHARD = 8 << 20, 16 << 20, 1 << 20, 64 << 10
#: Different contexts of an anchor beyond which their windows are compared one by one.
HOT = 1 << 13
#: Occurrences of an anchor beyond which they are dealt by context too, as far as one in
#: ``SAMPLED`` rows shows them; that says where they go and not what is found.
FREQUENT, SAMPLED = 1 << 18, 64


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of each run of ``width`` values."""
    out, done = values, 1
    while 2 * done <= width:
        out = pick(out[:-done], out[done:])
        done *= 2
    if done < width:
        out = pick(out[:len(out) - (width - done)], out[width - done:])
    return out


def anchors(data: np.ndarray, bounds: np.ndarray, length: int, gram: int
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, place in it, hash, and hash of the context of every minimizer of every text."""
    width = length - gram + 1
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    sums = T.prefix(data, T.EXACT)
    place = np.arange(len(data) - gram + 1)
    hashes = T.span_hash(sums, place, place + gram)
    order = (hashes >> np.uint64(32)).astype(np.uint32)
    least = sliding(order, width, np.minimum)  # of each window of the slice
    # A window that crosses a text bound is none: it must not select anything.
    text_of = np.searchsorted(bounds, np.arange(len(least)), "right") - 1
    whole = np.arange(len(least)) + length <= bounds[text_of + 1]
    least = np.where(whole, least, 0)
    padded = np.zeros(len(order) + width - 1, np.uint32)
    padded[width - 1:width - 1 + len(least)] = least
    most = sliding(padded, width, np.maximum)[:len(order)]
    at = np.flatnonzero(most == order)
    text = np.searchsorted(bounds, at, "right") - 1
    inside = at + gram <= bounds[text + 1]
    long_enough = (bounds[text + 1] - bounds[text]) >= length
    keep = inside & long_enough
    at, text = at[keep], text[keep]
    start = np.maximum(at - (width - 1), bounds[text])
    end = np.minimum(at + length, bounds[text + 1])
    context = T.span_hash(sums, start, end) + T.mix((at - start).astype(np.uint64))
    return text, at - bounds[text], hashes[at], context


def settle(key: np.ndarray, context: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """True for each anchor whose context also occurs in a smaller document."""
    order = np.lexsort((doc, context, key))
    k, c, d = key[order], context[order], doc[order]
    head = np.ones(len(k), bool)
    head[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    least = d[np.maximum.accumulate(np.where(head, np.arange(len(k)), 0))]
    out = np.zeros(len(k), bool)
    out[order] = d > least
    return out


def pack_columns(columns: list[np.ndarray]) -> bytes:
    return pa.compress(b"".join(np.ascontiguousarray(c).tobytes() for c in columns), "zstd",
                       asbytes=True)


def unpack_columns(blob: pa.Scalar, n: int, types: list) -> list[np.ndarray]:
    sizes = [np.dtype(t).itemsize * n for t in types]
    raw = pa.decompress(blob.as_buffer(), sum(sizes), "zstd", asbytes=True)
    starts = np.cumsum([0, *sizes])
    return [np.frombuffer(raw, t, n, int(s)) for t, s in zip(types, starts, strict=False)]


#: Columns of the anchors that are sent, and of those settled before.
SENT = [np.uint32, np.uint64, np.int64, np.int64, np.int32]
DONE = [np.int64, np.int32]


def frequent(docs: DataFrame, length: int, gram: int) -> np.ndarray:
    """Anchors with about ``FREQUENT`` occurrences or more; at most all anchors / ``FREQUENT``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0

        def counted() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(parts), return_counts=True)
            keys, n = keys[n > 1], n[n > 1]
            return pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])

        for batch in pieces(batches):
            for _, _, data, bounds in T.slices(batch.column(0)):
                parts.append(anchors(data, bounds, length, gram)[2])
                held += len(data)
                if held >= HELD:
                    yield counted()
                    parts, held = [], 0
        if parts:
            yield counted()

    rows = docs.where(F.pmod("row_key", F.lit(SAMPLED)) == 0).select("text")
    found = rows.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    keys = found.where(F.col("n") * SAMPLED >= FREQUENT).select("key").toArrow()["key"]
    return np.sort(keys.to_numpy().view(np.uint64))


def send_anchors(docs: DataFrame, groups: int, length: int, gram: int, often: np.ndarray
                 ) -> DataFrame:
    """Anchors of all texts, packed for each group. ``docs``: doc_id, row_key, text. The anchors
    ``often`` are dealt by their contexts too."""
    def packed(parts: list[tuple]) -> pa.RecordBatch:
        key, context, doc, row, place = (np.concatenate(x) for x in zip(*parts, strict=True))
        gone = settle(key, context, doc)
        deal = np.where(np.isin(key, often), T.mix(key ^ context), key) if len(often) else key
        group = ((deal >> np.uint64(16)) % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        cuts = np.searchsorted(group[order], np.arange(groups + 1))
        rows = []
        for g in range(groups):
            own = order[cuts[g]:cuts[g + 1]]
            if not len(own):
                continue
            live, dead = own[~gone[own]], own[gone[own]]
            rows.append((g, len(live), len(dead), pack_columns(
                [key[live].astype(np.uint32), context[live], doc[live], row[live], place[live]]),
                pack_columns([row[dead], place[dead]])))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
            ["group", "n_live", "n_dead", "live", "dead"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in pieces(batches):
            ids = batch.column(0).to_numpy()
            row_keys = batch.column(1).to_numpy()
            for first, _, data, bounds in T.slices(batch.column(2)):
                text, place, key, context = anchors(data, bounds, length, gram)
                if len(text):
                    text = text + first
                    parts.append((key, context, ids[text], row_keys[text],
                                  place.astype(np.int32)))
                held += len(data)
                if held >= HELD and parts:
                    yield packed(parts)
                    parts, held = [], 0
        if parts:
            yield packed(parts)

    return docs.mapInArrow(run, "group long, n_live long, n_dead long, live binary, dead binary")


def lists(keys: np.ndarray, *columns: np.ndarray) -> list:
    """The distinct keys, and the values of each column of each key as a list."""
    order = np.argsort(keys, kind="stable")
    head = np.flatnonzero(np.r_[True, np.diff(keys[order]) != 0]) if len(keys) else order
    offsets = pa.array(np.r_[head, len(keys)].astype(np.int32))
    return [pa.array(keys[order][head]),
            *(pa.ListArray.from_arrays(offsets, pa.array(c[order])) for c in columns)]


FOUND = "target long, n_gone long, n_asked long, gone binary, asked binary"
#: Columns of what is found: rows and places.
PLACES = [np.int64, np.int32]


def compare_anchors(table: pa.Table, groups: int, often: np.ndarray, most: int) -> pa.Table:
    """Of one group of anchors: places whose whole context goes, and contexts to be compared,
    packed for each of ``groups`` groups of rows. Places p of anchors with more than ``most``
    contexts, and of those ``often`` seen, are given as -1 - p."""
    live, dead = [], []
    for n_live, n_dead, a, b in zip(table["n_live"].to_pylist(), table["n_dead"].to_pylist(),
                                    table["live"], table["dead"], strict=True):
        live.append(unpack_columns(a, n_live, SENT))
        dead.append(unpack_columns(b, n_dead, DONE))
    key, context, doc, row, place = (np.concatenate(x) for x in zip(*live, strict=True))
    dead_row, dead_place = (np.concatenate(x) for x in zip(*dead, strict=True))
    gone = settle(key, context, doc)
    # Anchors with several contexts, of which one is in an earlier document than another.
    rest = np.flatnonzero(~gone)
    order = rest[np.lexsort((doc[rest], key[rest]))]
    k, d = key[order], doc[order]
    head = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else k
    size = np.diff(np.r_[head, len(k)])
    several = hot = np.zeros(len(k), bool)
    if len(k):
        spread_docs = d[np.r_[head[1:], len(k)] - 1] > d[head]
        # Other contexts of an anchor seen often may be in other groups.
        dealt = np.isin(k[head], often.astype(np.uint32))
        several = np.repeat(spread_docs | dealt, size)
        hot = np.repeat((size > most) | dealt, size)[several]
    asked = order[several]
    lost = [np.r_[row[gone], dead_row], np.r_[place[gone], dead_place]]
    open_ = [row[asked], np.where(hot[:len(asked)], -1 - place[asked], place[asked])]
    out = []
    cuts = []
    for columns in (lost, open_):
        target = columns[0] % groups
        by = np.argsort(target, kind="stable")
        columns[:] = [c[by] for c in columns]
        cuts.append(np.searchsorted(target[by], np.arange(groups + 1)))
    for g in range(groups):
        (a, b), (c, d) = ((cut[g], cut[g + 1]) for cut in cuts)
        if b > a or d > c:
            out.append((g, b - a, d - c, pack_columns([x[a:b] for x in lost]),
                        pack_columns([x[c:d] for x in open_])))
    names = ["target", "n_gone", "n_asked", "gone", "asked"]
    types = [pa.int64()] * 3 + [pa.binary()] * 2
    columns = zip(*out, strict=True) if out else [[]] * 5
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


BY_ROW = "row_key long, gone array<int>, asked array<int>"


def by_row(table: pa.Table) -> pa.Table:
    """What all groups of anchors found for a group of rows: one line for each row."""
    parts = [], []
    for n_gone, n_asked, a, b in zip(table["n_gone"].to_pylist(), table["n_asked"].to_pylist(),
                                     table["gone"], table["asked"], strict=True):
        parts[0].append(unpack_columns(a, n_gone, PLACES))
        parts[1].append(unpack_columns(b, n_asked, PLACES))
    gone, asked = ([np.concatenate(c) for c in zip(*p, strict=True)] for p in parts)
    keys = np.unique(np.r_[gone[0], asked[0]])
    arrays = [pa.array(keys)]
    for columns in (gone, asked):
        order = np.lexsort((columns[1], columns[0]))
        offsets = np.append(np.searchsorted(columns[0][order], keys), len(order))
        arrays += [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(c[order]))
                   for c in columns[1:]]
    return pa.table(arrays, ["row_key", "gone", "asked"])


def sides(raw: bytes, place: int, length: int, gram: int) -> Iterator[tuple[int, int, int]]:
    """The two halves of the context of an anchor: (hash of what its windows share, start, end).

    A window reaches at least half of the bytes beyond the anchor on one side, so equal windows
    have the anchor and that half in common: only contexts with an equal hash need to meet.
    """
    half = (length - gram) // 2
    if place + length - half <= len(raw):  # windows with up to half before the anchor
        yield (xxhash.xxh64_intdigest(raw[place:place + length - half], 1) >> 1,
               max(0, place - half), min(len(raw), place + length))
    if place > half:
        yield (xxhash.xxh64_intdigest(raw[place - half - 1:place + gram], 2) >> 1,
               max(0, place - length + gram), min(len(raw), place - half - 1 + length))


def window_starts(places: np.ndarray, n: int, length: int, gram: int) -> np.ndarray:
    """Starts of all windows in n bytes that hold one of the anchors."""
    start, end = spans_of(n, np.maximum(0, places - (length - gram)),
                          np.minimum(places, n - length) + 1)
    return T.spread(start, end - start)


def several_docs(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """True where a key occurs with more than one document."""
    order = np.lexsort((doc, key))
    k, d = key[order], doc[order]
    head = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else order
    size = np.diff(np.r_[head, len(k)])
    out = np.zeros(len(k), bool)
    if len(k):
        out[order] = np.repeat(d[head + size - 1] > d[head], size)
    return out


def rotations(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Order of all rotations of a shard by at least ``depth`` symbols, by prefix doubling."""
    rank, known = symbols.astype(np.int64), 1
    while known < depth:
        pair = rank * (int(rank.max()) + 1) + np.roll(rank, -known)
        _, rank = np.unique(pair, return_inverse=True)
        known *= 2
    return np.argsort(rank, kind="stable")


def merge(transforms: list[np.ndarray], rounds: int, end: int = 0
          ) -> tuple[np.ndarray, np.ndarray]:
    """Repeated intervals of the merged transforms: suffixes and the block of each.

    Suffixes are numbered through all shards, in the order of each shard. The result holds those
    whose first ``rounds`` symbols have no ``end`` among them and are also those of another
    suffix; they have one block number if and only if these symbols agree. A round puts one symbol
    in front: the suffixes of the interleave are sorted stably by the symbol before them, and the
    step to the suffix that starts with it (last to first) is known from its shard alone. A suffix
    that agrees with no other leaves the interleave, as whatever is put before it agrees with none.
    """
    symbols = np.concatenate(transforms)
    base = np.cumsum([0, *[len(t) for t in transforms]])
    step = np.empty(len(symbols), np.int32)
    for t, first in zip(transforms, base, strict=False):
        step[first + np.argsort(t, kind="stable")] = np.arange(first, first + len(t))
    suffix = np.arange(len(symbols), dtype=np.int32)
    block = np.zeros(len(symbols), np.int32)
    for _ in range(rounds):
        before = symbols[suffix]
        order = np.argsort(before, kind="stable")
        order = order[np.searchsorted(before[order], end, "right"):]  # ``end`` is the least symbol
        if not len(order):
            return suffix[:0], block[:0]
        before, came = before[order], block[order]
        head = np.ones(len(order) + 1, bool)
        head[1:-1] = (before[1:] != before[:-1]) | (came[1:] != came[:-1])
        shared = ~(head[:-1] & head[1:])
        block = np.cumsum(head[:-1], dtype=np.int32)[shared]
        suffix = step[suffix[order[shared]]]
    return suffix, block


def repeated(contexts: list[bytes], docs: np.ndarray, length: int, shard: int | None = None
             ) -> list[np.ndarray]:
    """Starts in each context of strings of ``length`` bytes that occur in a context of a smaller
    document. Contexts may repeat; a copy of a smaller document's context loses all its strings,
    also those that no other context holds."""
    if not contexts:
        return []
    shard = shard or SHARD
    found, number = {}, np.empty(len(contexts), np.int64)
    for i, text in enumerate(contexts):
        number[i] = found.setdefault(text, len(found))
    distinct = list(found)
    least = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(least, number, docs)
    groups, size = [[]], 0
    for i, text in enumerate(distinct):
        if size + len(text) > shard and groups[-1]:
            groups.append([])
            size = 0
        groups[-1].append(i)
        size += len(text) + 1
    transforms, owners, places = [], [], []
    for group in groups:
        lengths = np.array([len(distinct[i]) for i in group])
        raw = np.frombuffer(b"\0".join([distinct[i] for i in group]) + b"\0", np.uint8)
        symbols = raw.astype(np.uint16) + 1
        starts = np.cumsum(lengths + 1) - (lengths + 1)
        symbols[starts + lengths] = 0  # ends of contexts
        order = rotations(symbols, length)
        transforms.append(symbols[order - 1])
        owners.append(np.repeat(np.array(group), lengths + 1)[order])
        places.append((np.arange(len(symbols)) - np.repeat(starts, lengths + 1))[order])
    suffix, block = merge(transforms, length)
    owner, place = np.concatenate(owners)[suffix], np.concatenate(places)[suffix]
    first = np.full(int(block.max()) + 1 if len(block) else 0, np.iinfo(np.int64).max)
    np.minimum.at(first, block, least[owner])
    order = np.argsort(owner, kind="stable")
    owner, place, first = owner[order], place[order], first[block[order]]
    edges = np.searchsorted(owner, np.arange(len(distinct) + 1))
    out = []
    for n, doc in zip(number.tolist(), docs.tolist(), strict=True):
        if least[n] < doc:  # the same context in a smaller document: all its strings repeat
            out.append(np.arange(max(0, len(distinct[n]) - length + 1)))
            continue
        a, b = edges[n], edges[n + 1]
        out.append(place[a:b][first[a:b] < doc])
    return out


def spans_of(n: int, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals as maximal runs (start, end) within n bytes."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, end, -1)
    covered = np.r_[0, (np.cumsum(change)[:n] > 0).astype(np.int8), 0]
    edge = np.diff(covered)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def character_bounds(raw: bytes, start: np.ndarray, end: np.ndarray
                     ) -> tuple[np.ndarray, np.ndarray]:
    """The runs, widened to the bounds of the UTF-8 characters that they cut."""
    inner = np.r_[(np.frombuffer(raw, np.uint8) & 0xC0) == 0x80, False]
    for _ in range(3):  # a character has three bytes at most after its first
        start = start - (inner[start] & (start > 0))
        end = end + inner[end]
    return start, end


def dedup(documents: DataFrame, length: int = LENGTH, gram: int = GRAM,
          texts: bool = True, carry: bool = False, characters: bool = False) -> DataFrame:
    """What is left of every whole text of ``documents`` (doc_id, text) without repeated strings.

    Rows, one for each given: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, with
    ``texts``, kept (the remaining bytes). A null text counts as empty; texts shorter than
    ``length`` stay whole; null ids count as smaller than all others; rows of one id do not remove
    each other's strings; other columns are not read, unless ``carry`` puts all but the text into the
    struct ``row``; an empty table gives no rows. With ``characters`` each removed run is widened to
    whole UTF-8 characters.
    """
    extra = [F.struct(*[F.col(quoted(c)) for c in documents.columns if c != "text"]).alias("row")
             ] if carry else []
    whole = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *extra)
    key = F.xxhash64("doc_id", "text").alias("row_key")
    docs = whole.select("doc_id", key, "text")
    total = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    groups = max(1, -(-total // GROUP))
    often = frequent(docs, length, gram)
    anchored = send_anchors(docs, groups, length, gram, often).groupBy("group").applyInArrow(
        lambda table: compare_anchors(table, groups, often, HOT), FOUND)
    found = kept(anchored.groupBy("target").applyInArrow(by_row, BY_ROW), "anchors")
    single = found.select("row_key", F.filter("asked", lambda p: p >= 0).alias("asked"),
                          F.transform(F.filter("asked", lambda p: p < 0), lambda p: -1 - p
                                      ).alias("hot"))
    asked = single.where(F.size("asked") > 0).select("row_key", "asked")
    by_window = single.where(F.size("hot") > 0).select("row_key", "hot")
    sizes = single.agg(F.sum(F.size("asked")).alias("n"), F.sum(F.size("hot")).alias("hot")).first()
    n_asked = sizes.n or 0
    reach = 2 * (length + (length - gram) // 2)  # of both sides together
    merges = max(1, -(-n_asked * reach // MERGED))
    width = length - gram

    def compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sizes, blobs = [], []
            for text in batch.column(2):
                raw = text.as_buffer()
                sizes.append(raw.size)
                blobs.append(pa.compress(raw, "zstd", asbytes=True) if raw.size else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                 pa.array(blobs, pa.binary()), *batch.columns[3:]],
                ["doc_id", "row_key", "n", "data", *["row"] * len(batch.columns[3:])])

    def shrunk(rows: DataFrame) -> DataFrame:
        return rows.mapInArrow(compressed, result_schema(
            rows, "doc_id long, row_key long, n long, data binary"))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            doc_ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = []
            for i in range(batch.num_rows):
                n = batch.column(2)[i].as_py()
                raw = pa.decompress(batch.column(3)[i].as_buffer(), n, "zstd", asbytes=True)
                for p in batch.column(4)[i].as_py():
                    for side, start, end in sides(raw, p, length, gram):
                        out.append((side % merges, side, doc_ids[i], keys[i], start,
                                    raw[start:end]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 6, (
                    pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()),
                    strict=True)],
                ["merge", "side", "doc_id", "row_key", "start", "context"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            doc_ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i in range(batch.num_rows):
                n = batch.column(2)[i].as_py()
                raw = pa.decompress(batch.column(3)[i].as_buffer(), n, "zstd", asbytes=True)
                at = window_starts(batch.column(4)[i].values.to_numpy().astype(np.int64), n, length,
                                   gram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([xxhash.xxh3_128_digest(raw[a:a + length]) for a in at.tolist()],
                              pa.binary()),
                     pa.array(np.repeat(doc_ids[i], len(at))), pa.array(np.repeat(keys[i], len(at))),
                     pa.array(at.astype(np.int32))], ["window", "doc_id", "row_key", "start"])

    def compare(table: pa.Table) -> pa.Table:
        table = table.filter(pa.array(several_docs(table["side"].to_numpy(),
                                                   table["doc_id"].to_numpy())))
        starts = repeated(table["context"].to_pylist(), table["doc_id"].to_numpy(), length)
        count = np.array([len(s) for s in starts], np.int64)
        base = np.repeat(table["start"].to_numpy(), count)
        keys = np.repeat(table["row_key"].to_numpy(), count)
        places = (np.concatenate([*starts, np.zeros(0, np.int64)]) + base).astype(np.int32)
        pairs = np.unique(np.array([keys, places.astype(np.int64)]), axis=1)
        names = ["row_key", "windows"]
        return pa.table(lists(pairs[0], pairs[1].astype(np.int32)), names)

    compared = kept(shrunk(docs).join(asked, "row_key").select(
        "doc_id", "row_key", "n", "data", "asked").mapInArrow(
        contexts, "merge long, side long, doc_id long, row_key long, start int, context binary"
        ).groupBy("merge").applyInArrow(compare, "row_key long, windows array<int>"), "windows")
    if sizes.hot:
        seen = kept(shrunk(docs).join(by_window, "row_key").select(
            "doc_id", "row_key", "n", "data", "hot").mapInArrow(
            hashed, "window binary, doc_id long, row_key long, start int"), "hot-windows")
        least = kept(seen.groupBy("window").agg(
            F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where(
            "least < most").select("window", "least"), "least")
        compared = compared.unionAll(seen.join(least, "window").where("doc_id > least").groupBy(
            "row_key").agg(F.collect_set("start").alias("windows")))
    windows = compared.groupBy("row_key").agg(
        F.flatten(F.collect_list("windows")).alias("windows"))
    per_row = found.select("row_key", "gone").join(windows, "row_key", "left")
    fields = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (
        ", kept binary" if texts else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out = []
            for i in range(batch.num_rows):
                n = batch.column(1)[i].as_py()
                raw = pa.decompress(batch.column(2)[i].as_buffer(), n, "zstd",
                                    asbytes=True) if n else b""
                lost, windows = batch.column(3)[i], batch.column(4)[i]
                p = lost.values.to_numpy().astype(np.int64) if lost.is_valid else np.zeros(
                    0, np.int64)
                w = windows.values.to_numpy().astype(np.int64) if windows.is_valid else np.zeros(
                    0, np.int64)
                start, end = spans_of(n, np.r_[np.maximum(0, p - width), w],
                                      np.r_[np.minimum(n, p + length), w + length])
                if characters:
                    start, end = spans_of(n, *character_bounds(raw, start, end))
                left = b"".join([raw[a:b] for a, b in zip([0, *end.tolist()],
                                                         [*start.tolist(), n], strict=True)])
                out.append((batch.column(0)[i].as_py(), n, n - len(left), len(start),
                            hashlib.sha256(left).hexdigest(), left)[:6 if texts else 5])
            types = [pa.int64()] * 4 + [pa.string(), pa.binary()][:2 if texts else 1]
            names = [f.strip().split(" ")[0] for f in fields.split(",")]
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                columns + batch.columns[5:], names + ["row"] * len(batch.columns[5:]))

    rows = shrunk(whole.select("doc_id", key, "text", *["row"] * carry)).join(
        per_row, "row_key", "left").select("doc_id", "n", "data", "gone", "windows",
                                           *["row"] * carry)
    done = rows.mapInArrow(cut, result_schema(rows, fields))
    return done.withColumn("doc_id", F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")))


