"""Pairs of very many marked keys: every row is shuffled once, by its keys, and no sides are joined."""

import datetime
import itertools
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from plumbline.operators import recon

DDL = "k double, s string, n int, d double, t string, big decimal(38,2), at timestamp, arr array<int>"
LONG = "a text longer than the sixteen bytes of its hash "


def _row(rnd):
    pick = lambda *of: rnd.choice([None, *of])
    return (pick(0.0, -0.0, float("nan"), 1.5), pick("x", LONG), pick(1, 2), pick(0.0, -0.0, float("nan"), 2.5),
            pick(LONG + "1", LONG + "2", ""), pick(Decimal("1.00"), Decimal("12345678901234567890.25")),
            pick(datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 1, 0, 0, 0, 1)),
            pick([1, None], [None, 1], []))


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return tuple(v) if isinstance(v, list) else v


def _brute(left, right, keys):
    names = [c.split()[0] for c in DDL.replace("(38,2)", "").split(", ")]
    out = {}
    for a, b in itertools.product(*([[_plain(v) for v in r] for r in t] for t in (left, right))):
        if a[:keys] == b[:keys]:
            for c, x, y in zip(names[keys:], a[keys:], b[keys:], strict=True):
                out[c] = out.get(c, 0) + (x != y)
    return {c: n for c, n in out.items() if n}


@pytest.mark.parametrize("hot,pass_rows", [(10_000, 10**9), (3, 0), (0, 0)])
@pytest.mark.parametrize("keys", [["k"], ["k", "s"]])
def test_counts_match_brute_force(spark, monkeypatch, keys, hot, pass_rows):
    monkeypatch.setattr(recon, "FEW_KEYS", 0)
    monkeypatch.setattr(recon, "HOT_ROWS", hot)
    monkeypatch.setattr(recon, "PASS_ROWS", pass_rows)
    rnd = random.Random(f"{keys}{hot}")
    left, right = ([_row(rnd) for _ in range(n)] for n in (40, 35))
    lhs, rhs = (spark.createDataFrame(t, DDL).repartition(3) for t in (left, right))
    want = _brute(left, right, len(keys))
    assert want
    got = recon.check_cells(lhs, rhs, keys).collect()
    assert len(got) == len(want) and {r.col_name: r.mismatch_cnt for r in got} == want
    found = recon.scan_keys(lhs, rhs, keys)
    diffs = recon.cell_diff(lhs, rhs, keys, found)
    again = recon.check_cells(lhs, rhs, keys, found, diffs).collect()
    assert {r.col_name: r.mismatch_cnt for r in again} == want


def _sides(spark):
    left = spark.range(600).selectExpr("id % 250 AS k", "id % 7 AS v", "cast(id AS string) AS w")
    return left, left.withColumn("v", F.when(F.col("k") % 3 == 0, -F.col("v")).otherwise(F.col("v")))


def test_many_marked_keys_are_counted_from_one_shuffle_without_a_join(spark, plan, monkeypatch):
    want = {r.col_name: r.mismatch_cnt for r in recon.check_cells(*_sides(spark), ["k"]).collect()}
    monkeypatch.setattr(recon, "FEW_KEYS", 0)
    counts = recon.check_cells(*_sides(spark), ["k"])
    tree = plan(counts).split("\n\n\n")[0]
    assert "Join" not in tree
    assert sum("Exchange (" in line for line in tree.splitlines()) == 2  # rows, and a sum per column
    assert {r.col_name: r.mismatch_cnt for r in counts.collect()} == want


def test_tasks_follow_the_cells_and_passes_share_the_keys(spark, monkeypatch):
    monkeypatch.setattr(recon, "FEW_KEYS", 0)
    monkeypatch.setattr(recon, "TASK_CELLS", 100)  # 1200 rows of two cells: 24 tasks
    count = lambda: recon.check_cells(
        *_sides(spark), ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert count().count("RepartitionByExpression") == 1 and ", 24" in count()
    monkeypatch.setattr(recon, "PASS_ROWS", 1000)
    assert count().count("RepartitionByExpression") == 4 and ", 6" in count()


def test_hot_keys_are_left_out_of_the_shuffle_by_key(spark, monkeypatch):
    """Also a hot key that nothing else marks: its rows are equal, or on one side only."""
    monkeypatch.setattr(recon, "HOT_ROWS", 50)
    rows = spark.range(300).selectExpr("if(id < 100, -1, id) AS k", "if(id < 100, 1, id) AS v")
    other = spark.range(1).selectExpr("-1L AS k", "1L AS v").union(rows.filter("k > 0"))
    found = recon.scan_keys(rows, other, ["k"])
    assert found.totals["hot"] == 1 and found.totals["marked"] == 0 and found.marked.count() == 0
    assert [r.k for r in found.hot.collect()] == [-1]
    assert found.totals["pairs"] == 100 + 200 and found.totals["pairs_repeated"] == 0


def test_zeros_inside_nested_values_stay_equal(spark, monkeypatch):
    """Values equal to Spark but not to a hash are compared themselves, however many keys there are."""
    ddl = "k int, v int, arr array<double>, s struct<x: float>"
    left = spark.createDataFrame([(1, 1, [0.0], (0.0,)), (2, 2, [1.0], (2.0,))], ddl)
    right = spark.createDataFrame([(1, 9, [-0.0], (-0.0,)), (2, 2, [1.0], (3.0,))], ddl)
    for few in (1000, 0):
        monkeypatch.setattr(recon, "FEW_KEYS", few)
        got = recon.check_cells(left, right, ["k"]).collect()
        assert {r.col_name: r.mismatch_cnt for r in got} == {"v": 1, "s": 1}
