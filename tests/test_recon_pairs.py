"""Pairs of keys repeated on both sides, when their key list is too long to broadcast."""

import itertools

from pyspark.sql import functions as F

from plumbline.operators import recon

ROWS = [(k, n, v, w) for k in range(6) for n in range(1 + k % 3)
        for v, w in [(k * 10 + n % 2, f"w{n}")]]


def _sides(spark):
    left = spark.createDataFrame(ROWS, "k long, n int, v long, w string")
    right = left.withColumn("v", F.when(F.col("n") == 0, F.col("v") + 1).otherwise(F.col("v")))
    return left, right


def _brute(left, right):
    out = {}
    for a, b in itertools.product(left.collect(), right.collect()):
        if a.k == b.k:
            for c in ("n", "v", "w"):
                out[c] = out.get(c, 0) + (a[c] != b[c])
    return {c: n for c, n in out.items() if n}


def test_repeated_pairs_unbroadcast_hash_after_the_join(spark, monkeypatch):
    monkeypatch.setattr(recon, "FEW_KEYS", 0)
    left, right = _sides(spark)
    got = recon.check_cells(left, right, ["k"])
    assert {r.col_name: r.mismatch_cnt for r in got.collect()} == _brute(left, right)
    found = recon.scan_keys(left, right, ["k"])
    counts = recon._repeated_pair_counts(left, right, ["k"], found)
    plan = counts._jdf.queryExecution().optimizedPlan().treeString()
    lines = plan.splitlines()
    for at, line in enumerate(lines):
        if "Join LeftSemi" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            below = itertools.takewhile(
                lambda x: len(x) - len(x.lstrip(" :+-")) > depth, lines[at + 1:])
            assert not any("cells" in x for x in below), plan
