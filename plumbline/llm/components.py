"""Connected components of a graph in a table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.tables import kept


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge to another; root is its component's least node.

    ``edges`` has long columns u and v. Each round hangs a node's larger neighbours, then its smaller
    ones, under its least neighbour; the number of rounds grows with the logarithm of the nodes. A
    round is written to the shared folder, so a lost executor costs one round at most.
    """
    up = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    now = kept(edges.where("u <> v").select(*up).distinct(), "edges")
    mark = None
    while True:
        both = now.select(F.col("u").alias("x"), F.col("v").alias("y")).unionAll(
            now.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select(
            "x", F.least("x", "m").alias("m"))
        large = both.join(least, "x").where("y > x").select(
            F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select("u", F.col("m").alias("v")).unionAll(
            joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        now = kept(small.distinct(), "edges")
        seen = now.agg(F.count("*").alias("n"),
                       F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if mark == (seen.n, seen.s):
            break
        mark = (seen.n, seen.s)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
