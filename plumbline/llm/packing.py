"""Packing of documents into token sequences: first-fit decreasing in randomised groups.

Each document is tokenized where it is read and cut into pieces of at most ``length`` ids. Only
piece descriptions travel. They are written once and counted, and each goes to a random group of
bounded expected size. A group is packed alone by first-fit decreasing: pieces by falling length, each
into the first open sequence with room, which a tournament tree over the free space of the
sequences finds in logarithmic time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import text as T
from plumbline.llm.tables import kept, pieces
from plumbline.llm.tokens import ByteEncoder

LENGTH = 1024
#: Expected pieces of a group, so a group is some hundred KB at any size of the input.
GROUP = 8192

PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
         "group_key long, mark long")
PACKED = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


class Tournament:
    """Free space of the bins of a group; the winner of each match is the larger one."""

    def __init__(self, bins: int, space: int) -> None:
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.tree = [space] * (2 * self.leaves)

    def first_fit(self, size: int) -> tuple[int, int]:
        """Take ``size`` from the first bin that has room; its number and the space it had left."""
        tree, node = self.tree, 1
        while node < self.leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        had = tree[node]
        tree[node] = had - size
        bin_ = node - self.leaves
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
        return bin_, had


def first_fit_decreasing(lengths: list[int], space: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length; ``lengths`` must fall."""
    tree, bins, offsets = Tournament(len(lengths), space), [], []
    for size in lengths:
        bin_, had = tree.first_fit(size)
        bins.append(bin_)
        offsets.append(space - had)
    return bins, offsets


def cut(documents: DataFrame, path: str, length: int = LENGTH, end_id: int = 0) -> DataFrame:
    """Pieces of each row's ids and ``end_id``: full ones first, the rest last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteEncoder.load(path)
        for batch in pieces(batches):
            doc_ids = batch.column(0)
            for first, end, data, bounds in T.slices(batch.column(1)):
                ids, counts = encoder.slice(data, bounds)
                at = np.cumsum(counts)
                # Each document gets the end id after its own ids.
                ids = np.insert(ids, at, end_id).astype("<u4")
                counts = counts + 1
                begins = np.cumsum(counts) - counts
                parts = -(-counts // length)
                row = np.repeat(np.arange(len(counts)), parts)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)) * length
                size = np.minimum(length, counts[row] - start)
                raw, place = memoryview(ids.tobytes()), (begins[row] + start) * 4
                crc = [zlib.crc32(raw[a:b]) for a, b in
                       zip(place.tolist(), (place + size * 4).tolist(), strict=True)]
                key = T.mix(np.array(crc, np.uint64) << np.uint64(20) ^ start.astype(np.uint64)
                            ^ counts[row].astype(np.uint64) << np.uint64(40))
                own = doc_ids.slice(first, end - first).take(pa.array(row))
                known = own.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.uint64)
                key = T.mix(key ^ T.mix(known)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [own, *map(pa.array, (start, size, np.array(crc, np.int64), counts[row],
                                          key, key >> 1))],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "group_key", "mark"])

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")
                            ).mapInArrow(run, PIECE)


def pack(documents: DataFrame, path: str, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """Every token of ``documents`` (doc_id, text) in exactly one place of one sequence.

    Rows: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A null text counts as
    empty and gives one end id; a null doc_id stays null; repeated rows are packed each for
    itself; other columns are not read; an empty table gives no rows. Ties of the packing order
    follow doc_id, start and crc, so equal input gives equal sequences.
    """
    if length & (length - 1):
        raise ValueError("length must be a power of two")
    rows = kept(cut(documents, path, length), "pieces")
    groups = max(1, -(-rows.count() // group))
    # The place in the written table spreads equal rows; a task that runs again finds the same one.
    dice = F.xxhash64("group_key", F.monotonically_increasing_id())
    rows = rows.withColumn("group", F.pmod(dice, F.lit(groups)))

    def run(table: pa.Table) -> pa.Table:
        sizes = table["length"].to_numpy()
        order = np.lexsort((table["mark"].to_numpy(), table["ids_crc32"].to_numpy(),
                            table["start"].to_numpy(),
                            table["doc_id"].fill_null(-1).to_numpy(), -sizes))
        bins, offsets = first_fit_decreasing(sizes[order].tolist(), length)
        base = np.int64(table["group"][0].as_py()) << 32
        out = table.select(["doc_id", "start", "length", "ids_crc32", "doc_tokens"]).take(
            pa.array(order))
        return out.append_column("sequence_id", pa.array(base + np.array(bins, np.int64))
                                 ).append_column("offset", pa.array(np.array(offsets, np.int64)))

    return rows.groupBy("group").applyInArrow(run, PACKED)
