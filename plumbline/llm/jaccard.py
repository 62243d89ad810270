"""N-gram Jaccard join: MinHash banding, then verification on the full n-gram sets.

Documents with equal sets of word n-grams form a class first, so copies cost one row. Each class
sends its band hashes, not its text; classes that share a band hash are joined to the least one
of their bucket, which is linear in the bucket, and the components of these joins gather all
classes that could be similar. Each component's texts meet once and every pair in it is compared
on the full sets by a blocked sparse product. A component of more than ``BLOCK`` classes is cut
into blocks that meet pair by pair, each in a task of its own. Only counts and a spanning forest of
the verified links leave a task, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import text as T
from plumbline.llm.components import components
from plumbline.llm.tables import kept, pieces, texts_of

SIZE = 5
THRESHOLD = 0.8
RECALL = 0.9999
#: Classes of a block: bounds the texts that a verifying task holds.
BLOCK = 512
#: N-grams compared at once in a block.
COLUMNS = 4096


def bands_for(threshold: float, recall: float, hashes: int = 160) -> tuple[int, int]:
    """(bands, rows): the most rows a band, for few false candidates, that ``hashes`` allow while a
    pair at ``threshold`` shares a band with probability ``recall``."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1)
    for rows in range(2, hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))
        if bands * rows > hashes:
            break
        best = (bands, rows)
    return best


def ngram_sets(array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, text, hash) of the distinct n-grams of each text, slice by slice."""
    for first, end, data, bounds in T.slices(array):
        grams, text = T.shingles(*T.word_hashes(data, bounds, T.SPACED, T.FOLDED), size)
        order = np.lexsort((grams, text))
        grams, text = grams[order], text[order]
        fresh = np.ones(len(grams), bool)
        fresh[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
        yield first, end - first, text[fresh], grams[fresh]


def set_hashes(grams: np.ndarray, head: np.ndarray) -> np.ndarray:
    """One value for each set of distinct n-grams that starts at ``head``."""
    if not len(head):
        return np.zeros(0, np.int64)
    return T.mix(np.add.reduceat(T.mix(grams), head)).view(np.int64)


SIGNED = "doc_id long, row_key long, node long, size long, bands array<long>"


def signatures(documents: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """Set hash (node), set size and band hashes of every text; null and no bands without words.

    ``documents``: doc_id, text, row_key.
    """
    a = T.mix(np.arange(1, bands * rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | \
        np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            for first, n, text, grams in ngram_sets(batch.column(1), size):
                head = np.flatnonzero(np.r_[True, text[1:] != text[:-1]]) if len(text) else text
                owner = text[head]
                keys = np.zeros((len(head), bands), np.uint64)
                node = set_hashes(grams, head)
                if len(head):
                    for band in range(bands):
                        for k in range(band * rows, (band + 1) * rows):
                            least = np.minimum.reduceat(grams * a[k], head)
                            keys[:, band] = T.mix(keys[:, band] ^ least) + a[band]
                counts = np.bincount(text, minlength=n)
                some = counts > 0
                nodes = np.zeros(n, np.int64)
                nodes[owner] = node
                offsets = np.r_[0, np.cumsum(some) * bands].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), batch.column(2).slice(first, n),
                     pa.array(nodes, mask=~some),
                     pa.array(counts.astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(offsets),
                                              pa.array(keys.view(np.int64).ravel()))],
                    ["doc_id", "row_key", "node", "size", "bands"])

    return documents.mapInArrow(run, SIGNED)


def linked(table: pa.Table, size: int, threshold: float, inner: bool) -> pa.Table:
    """Links of the classes in one block (``inner``) or between the two sides of a pair of blocks.

    Rows: node, links (documents of the classes it is linked to) and a node of its group to which
    it is connected.
    """
    texts, grams = [], []
    for first, _, text, own in ngram_sets(table["text"], size):
        texts.append(text + first)
        grams.append(own)
    text, grams = np.concatenate(texts), np.concatenate(grams)
    # A row that came along by its key alone, with another set, is left out.
    head = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    expected = table["node"].to_numpy()[text[head]]
    right = text[head][set_hashes(grams, head) == expected]
    if len(right) < table.num_rows:
        keep = np.isin(text, right)
        text, grams = np.searchsorted(right, text[keep]), grams[keep]
        table = table.take(pa.array(right))
    n = table.num_rows
    sizes = np.bincount(text, minlength=n)
    codes, keys = pd.factorize(grams)
    shared = np.bincount(codes, minlength=len(keys)) > 1
    number = np.cumsum(shared) - 1
    keep = shared[codes]
    column, row = number[codes[keep]], text[keep]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    both = np.zeros((n, n), np.float32)
    total = int(shared.sum())
    for low in range(0, total, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        block = np.zeros((n, min(COLUMNS, total - low)), np.float32)
        block[row[a:b], column[a:b] - low] = 1
        both += block @ block.T
    union = sizes[:, None] + sizes[None, :] - both
    near = both >= threshold * union - 1e-6
    np.fill_diagonal(near, False)
    if not inner:
        side = table["side"].to_numpy()
        near &= side[:, None] != side[None, :]
    copies = table["copies"].to_numpy()
    links = near @ copies
    nodes = table["node"].to_numpy()
    root = np.full(n, -1)
    for i in np.argsort(nodes).tolist():
        if root[i] < 0:
            root[i] = i
            front = np.array([i])
            while len(front):
                front = np.flatnonzero(near[front].any(0) & (root < 0))
                root[front] = i
    some = links > 0
    return pa.table({"node": nodes[some], "links": links[some].astype(np.int64),
                     "peer": nodes[root[some]]})


def join(documents: DataFrame, size: int = SIZE, threshold: float = THRESHOLD,
         recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """Near-duplicate class of every document of ``documents`` (doc_id, text).

    Two documents are linked if the Jaccard similarity of their sets of ``size``-word n-grams
    (lower-cased A-Z, split at white space; of a shorter text all its words as one) is at least
    ``threshold``; classes are the connected components of the links. Rows, one for each row given:
    doc_id, class_id (the least doc_id of the class), links (how many other rows it is linked to),
    row_key (hash of id and text) and class_key (that of the class's first row, null without words).
    A text without words (null, empty, white space) is linked to none and is its own class; null
    ids take part and sort last, a class of null ids alone has a null class_id; repeated rows are
    linked to each other; other columns are not read; an empty table gives no rows.

    Every pair in a group of candidates is compared on its full sets; candidates are found with
    probability ``recall`` for a pair at the threshold, and more for closer ones and for chains.
    """
    bands, rows = bands_for(threshold, recall)
    docs = texts_of(documents).withColumn("row_key", F.xxhash64("doc_id", "text"))
    signed = kept(signatures(docs, size, bands, rows), "signatures")
    classes = kept(signed.where("node is not null").groupBy("node").agg(
        F.count("*").alias("copies"), F.min(F.struct(
            F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("first"),
        F.min("row_key").alias("row_key"), F.first("bands").alias("bands")), "classes")
    keys = classes.select("node", F.explode("bands").alias("key"))
    hubs = keys.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where(
        "n > 1").select("key", "hub")
    groups = components(keys.join(hubs, "key").where("node <> hub").select(
        F.col("node").alias("u"), F.col("hub").alias("v")))
    blocks = groups.groupBy("root").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    members = groups.join(blocks, "root").join(
        classes.select("node", "copies", "row_key"), "node").withColumn(
        "at", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # One row of each class brings its text.
    texts = docs.select("row_key", "text").join(members, "row_key").dropDuplicates(["node"])
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = texts.withColumn("other", other).select(
        "root", F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"),
        (F.col("at") > F.col("other")).alias("side"), "node", "copies", "text")

    def verify(table: pa.Table) -> pa.Table:
        inner = table["i"][0].as_py() == table["j"][0].as_py()
        return linked(table, size, threshold, inner)

    found = kept(met.groupBy("root", "i", "j").applyInArrow(
        verify, "node long, links long, peer long"), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("node").alias("u"), F.col("peer").alias("v")))
    named = classes.select("node", "copies", "first").join(joined, "node", "left").join(
        links, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("first").alias("least"))
    info = named.join(least, "root").select(
        "node", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    alone = F.col("node").isNull()
    return signed.select("doc_id", "row_key", "node").join(info, "node", "left").select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("links"), "row_key",
        F.when(alone, F.lit(None)).otherwise(F.col("least.row_key")).alias("class_key"))


def representatives(documents: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of ``documents`` that stay: one of each class of ``join``, its least doc_id.

    Rows without words stay all. Of equal rows (id and text) that stand for a class one stays.
    """
    stay = classes.where("class_key is null or class_key = row_key").groupBy("row_key").agg(
        F.count("class_key").alias("equal"))
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = texts_of(documents, carry=True).select("row", key.alias("row_key"))
    once = rows.join(stay.where("equal <= 1"), "row_key", "left_semi").select("row")
    if stay.where("equal > 1").isEmpty():
        return once.select("row.*")
    several = rows.join(stay.where("equal > 1"), "row_key", "left_semi").groupBy("row_key").agg(
        F.first("row").alias("row"))
    return once.unionAll(several.select("row")).select("row.*")
