"""Approximate nearest neighbours by inner product, with collision-counting hashing.

Vectors are lifted by one component so that the largest inner product is the smallest distance. A
block of vectors keeps one sorted array for each of ``PROJECTIONS`` random directions. For a query,
windows centred on its own projections grow with the search radius (virtual rehashing: the same
arrays serve every radius), and each vector counts the windows that hold it. Vectors whose count
reaches the collision threshold are verified by their exact inner product. The search of a block
ends when the radius has reached the k-th best verified distance: a vector within the radius has
then been counted often enough with probability ``RECALL``. There is no cap on candidates.

Blocks hold at most ``BLOCK`` vectors in expectation and meet blocks of queries, each pair in a
task of its own; a task returns k rows for each of its queries.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PROJECTIONS = 64
#: Half width of a window in units of the radius.
WIDTH = 1.0
#: Probability that a vector at the radius reaches the threshold.
RECALL = 0.98
#: First radius and its growth, in units where lifted vectors have length 1.
FIRST, GROWTH = 0.6, 1.25
BLOCK, QUERIES = 8192, 1024

FOUND = "query_id long, vec_id long, score double"


def threshold(projections: int, width: float, recall: float) -> int:
    """Collisions that a vector at the radius reaches with probability ``recall``."""
    hit = 2 * NormalDist().cdf(width) - 1
    total, at = 0.0, projections + 1
    while total < recall:  # exact binomial tail
        at -= 1
        total += math.comb(projections, at) * hit ** at * (1 - hit) ** (projections - at)
    return max(1, at)


def lift(vectors: np.ndarray, largest: float) -> np.ndarray:
    """Vectors over ``largest``, with a last component that makes their length 1."""
    scaled = vectors / largest
    rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(1)))
    return np.c_[scaled, rest]


class Index:
    """Sorted projections of the vectors of one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float,
                 projections: int = PROJECTIONS) -> None:
        self.ids, self.vectors = ids, vectors
        self.directions = np.random.default_rng(20240229).standard_normal(
            (vectors.shape[1] + 1, projections))
        values = lift(vectors, largest) @ self.directions
        self.order = [np.argsort(values[:, j], kind="stable") for j in range(projections)]
        self.sorted = [values[o, j] for j, o in enumerate(self.order)]
        self.largest = largest
        self.need = threshold(projections, WIDTH, RECALL)

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query number, vector number, score) of the k best verified of each query."""
        n, m = len(self.ids), len(self.sorted)
        length = np.sqrt((queries * queries).sum(1))
        centre = np.c_[queries / length[:, None], np.zeros(len(queries))] @ self.directions
        left = np.array([np.searchsorted(s, centre[:, j]) for j, s in enumerate(self.sorted)])
        right = left.copy()
        counts = np.zeros((len(queries), n), np.uint8 if m < 256 else np.uint16)
        checked = np.zeros((len(queries), n), bool)
        score = [np.zeros(0) for _ in ids]
        known = [np.zeros(0, np.int64) for _ in ids]
        radius = np.full(len(queries), FIRST)
        slack = 1e-12 * self.largest * self.vectors.shape[1]  # rounding of a product
        active = np.arange(len(queries))
        while len(active):
            half = WIDTH * radius[active]
            low = np.array([np.searchsorted(s, centre[active, j] - half, "left")
                            for j, s in enumerate(self.sorted)])
            high = np.array([np.searchsorted(s, centre[active, j] + half, "right")
                             for j, s in enumerate(self.sorted)])
            low, high = np.minimum(low, left[:, active]), np.maximum(high, right[:, active])
            going = np.ones(len(active), bool)
            for a, q in enumerate(active.tolist()):
                parts = []
                for o, l0, l1, h1, h0 in zip(self.order, low[:, a].tolist(), left[:, q].tolist(),
                                             right[:, q].tolist(), high[:, a].tolist(),
                                             strict=True):
                    parts.append(o[l0:l1])
                    parts.append(o[h1:h0])
                counts[q] += np.bincount(np.concatenate(parts), minlength=n).astype(counts.dtype)
                new = np.flatnonzero((counts[q] >= self.need) & ~checked[q])
                checked[q, new] = True
                new = new[self.ids[new] != ids[q]]
                # One product for all; those that may be among the best are then summed row by
                # row, so that equal vectors get equal scores.
                found = self.vectors[new] @ queries[q]
                if len(score[q]) + len(new) > k:
                    both = np.r_[score[q], found]
                    limit = np.partition(both, -k)[-k]
                    new = new[found >= limit - slack * length[q]]
                known[q] = np.r_[known[q], new]
                score[q] = np.r_[score[q], (self.vectors[new] * queries[q]).sum(1)]
                if len(known[q]) > k:
                    best = np.lexsort((self.ids[known[q]], -score[q]))[:k]
                    known[q], score[q] = known[q][best], score[q][best]
                everything = (low[:, a] == 0).all() and (high[:, a] == n).all()
                worst = math.inf
                if len(score[q]) >= k:
                    close = score[q].min() / (self.largest * length[q])
                    worst = math.sqrt(max(0.0, 2 - 2 * close))
                if everything or radius[q] >= worst:
                    going[a] = False
                else:
                    radius[q] = min(radius[q] * GROWTH, max(worst, radius[q] * 1.001))
            left[:, active], right[:, active] = low, high
            active = active[going]
        number = np.repeat(np.arange(len(ids)), [len(x) for x in known])
        return (number, np.concatenate([*known, np.zeros(0, np.int64)]).astype(np.int64),
                np.concatenate([*score, np.zeros(0)]))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that take part: no null, zero or non-finite vectors, and
    none whose length differs from the most frequent one (of equal ones the greatest)."""
    value = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long"), value.alias("embedding")).where(
        "vec_id is not null and embedding is not null")
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                    & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(good & F.exists("embedding", lambda x: x != 0))
    sizes = rows.groupBy(F.size("embedding").alias("n")).agg(F.count("*").alias("c")).orderBy(
        F.desc("c"), F.desc("n")).first()
    return rows.where(F.size("embedding") == (sizes.n if sizes else 0))


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, block: int = BLOCK,
           per_task: int = QUERIES) -> DataFrame:
    """The k nearest of ``vectors`` (vec_id, embedding) found for each row of ``queries``.

    Rows: query_id, rank from 1, vec_id, score (inner product of the given vectors, in double
    precision); nearest first, ties to the smaller vec_id; all candidates if fewer than k. A vector
    is no candidate for queries of its own id. Null, zero and non-finite vectors take no part; of
    repeated rows of a query any one is searched, repeated candidates count each; other columns are
    not read; empty tables give no rows.
    """
    rows = usable(vectors)
    asked = usable(queries).dropDuplicates(["vec_id"])
    stats = rows.agg(F.count("*").alias("n"), F.max(F.aggregate(
        "embedding", F.lit(0.0), lambda s, x: s + x * x)).alias("m")).first()
    blocks = max(1, -(-stats.n // block))
    parts = max(1, -(-asked.count() // per_task))
    largest = math.sqrt(stats.m or 1.0) * (1 + 1e-12)
    data = rows.select(
        F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
        F.lit(False).alias("asks"), "vec_id", "embedding")
    wants = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("part"),
        F.lit(True).alias("asks"), "vec_id", "embedding")

    def run(table: pa.Table) -> pa.Table:
        asks = table["asks"].to_numpy()
        ids = table["vec_id"].to_numpy()
        values = table["embedding"].combine_chunks()
        matrix = values.flatten().to_numpy().reshape(len(ids), -1)
        wanted, given = ids[asks], ids[~asks]
        if not len(wanted) or not len(given):
            return pa.table({"query_id": pa.array([], pa.int64()),
                             "vec_id": pa.array([], pa.int64()),
                             "score": pa.array([], pa.float64())})
        index = Index(given, matrix[~asks], largest)
        parts = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0),)]
        for first in range(0, len(wanted), 256):  # bounds the counters
            q, v, s = index.search(wanted[first:first + 256], matrix[asks][first:first + 256], k)
            parts.append((wanted[first + q], given[v], s))
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    found = data.unionAll(wants).groupBy("block", "part").applyInArrow(run, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
