import datetime

import pytest
from pyspark.sql import functions as F

from plumbline.operators import relational
from plumbline.operators import warehouse as wh
from plumbline.session import scratch


def test_date_dim_has_every_day(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2023-12-30 10:00:00' AS ts UNION ALL "
                   "SELECT TIMESTAMP_NTZ '2024-01-02 01:00:00'")
    rows = {r.date_key: r for r in wh.date_dim(df, "ts").collect()}
    assert sorted(rows) == [20231230, 20231231, 20240101, 20240102]
    sunday = rows[20231231]
    assert (sunday.day_of_week, sunday.quarter, sunday.week) == (1, 4, 52)
    assert rows[20240101].full_date == datetime.date(2024, 1, 1)


def test_constraints_find_seeded_breaks(spark):
    child = spark.createDataFrame([(1, 10), (1, 10), (2, 99), (None, None)], "id int, ref int")
    parent = spark.createDataFrame([(10,), (20,)], "key int")
    assert wh.check_pk(child, ["id"], "pk").first().bad_rows == 3
    assert wh.check_fk(child, "ref", parent, "key", "fk").first().bad_rows == 1
    got = {r.rule: r.bad_rows for r in wh.check_not_null(child, ["id", "ref"]).collect()}
    assert got == {"id": 1, "ref": 1}


def test_type_audit(spark):
    df = spark.createDataFrame([("1", 1.25, "2024-01-01"), ("x", 2.5, "soon"), (None, 3.0, None)],
                               "k string, price double, day string")
    got = {r.col_name: (r.non_null, r.misfits, r.changed)
           for r in wh.type_audit(df, {"k": "int", "price": "decimal(10,1)", "day": "date"}).collect()}
    assert got == {"k": (2, 1, 0), "price": (3, 0, 1), "day": (2, 1, 0)}


def test_apply_default_keeps_the_type(spark):
    df = spark.createDataFrame([(None,), (2.5,)], "d double")
    out = wh.apply_default(df, {"d": 0})
    assert out.dtypes == [("d", "double")] and {r.d for r in out.collect()} == {0.0, 2.5}


def test_dry_run_names_row_column_value_and_reason(spark):
    df = spark.createDataFrame([("r1", "1", "x"), ("r2", "a", "y"), ("r3", None, "z")],
                               "row_id string, c0 string, c1 string")
    got = {tuple(r) for r in wh.load_dry_run(df, "id int not null, name string, extra int").collect()}
    assert got == {("r2", "id", "a", "not a int"), ("r3", "id", None, "missing")}


def test_hot_key_is_spread_and_rows_survive(spark):
    """One key holds a third of the rows, null another third."""
    df = spark.range(9000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("k"))
    laid = wh.layout_key(df, "k", 8)
    skew = wh.layout_skew(laid).first()
    assert skew.rows == 9000 and skew.max_rows < 2500
    assert laid.exceptAll(df).count() == 0 and df.exceptAll(laid).count() == 0
    plain = wh.layout_skew(df.repartition(8, "k")).first()
    assert plain.max_rows > 3000


def test_exact_copies_are_spread_too(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(5).alias("k"))
    assert wh.layout_skew(wh.layout_key(df, "k", 8)).first().max_rows < 2500


def test_rows_keep_their_salt_in_another_order(spark):
    df = spark.range(900).select("id", F.lit(1).alias("k"), F.array(F.col("id")).alias("a"))
    first = relational.salted(df, "k", [1], 8)
    again = relational.salted(df.repartition(5).orderBy(F.desc("id")), "k", [1], 8)
    assert first.exceptAll(again).count() == 0
    assert first.select("salt").distinct().count() == 8


def test_sort_layout_spreads_a_repeated_key(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"))
    assert wh.layout_skew(wh.layout_sort(df, ["k"], 8)).first().max_rows < 2500


def test_total_sort_spreads_ties_and_stays_sorted(spark):
    df = spark.range(9000).select((F.col("id") * 37 % 3).alias("k")).repartition(8)
    got = [r.k for r in relational.sort_spread(df, "k").collect()]
    assert got == sorted(got) and len(got) == 9000


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, how):
    big = spark.range(600).select("id", F.when(F.col("id") % 3 == 0, 0).when(
        F.col("id") % 3 == 1, F.col("id") % 10).alias("k"))
    other = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c"), (None, "n")], "k int, v string")
    hot = relational.hot_keys(big, "k", 0.2)
    assert set(hot) == {0, None}
    got = relational.salted_join(big, other, "k", hot, 4, how).select("id", "k", "v")
    want = big.join(other, "k", how).select("id", "k", "v")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_colocated_join_needs_no_exchange_and_splits_hot_keys(spark, plan):
    left = spark.range(3000).select(F.col("id").alias("a"), F.when(
        F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("long").alias("k"))
    right = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("b"))
    cold = wh.colocated_join(spark, left.filter("k <> 1"), right, "k", 4, scratch(spark, "co"))
    assert "Exchange" not in plan(cold).split("(1)")[0]
    both = wh.colocated_join(spark, left, right, "k", 4, scratch(spark, "co"))
    want = left.join(right, "k")
    assert both.select("k", "a", "b").exceptAll(want.select("k", "a", "b")).count() == 0
    assert both.count() == want.count()


def test_broadcast_needs_a_proven_size(spark, plan):
    small = spark.range(10)
    assert "ResolvedHint" in relational.broadcast_if_small(small)._jdf.queryExecution().analyzed().toString()
    for bound in ({"max_rows": 5}, {"max_bytes": 10}):
        kept = relational.broadcast_if_small(small, **bound)
        assert "ResolvedHint" not in kept._jdf.queryExecution().analyzed().toString()


def test_compact_reports_files(spark):
    a, b = scratch(spark, "small"), scratch(spark, "whole")
    spark.range(1000).repartition(10).write.parquet(a)
    done = wh.compact(spark, a, b)
    assert (done["files_before"], done["files_after"], done["rows"]) == (10, 1, 1000)
    assert done["bytes_after"] < done["bytes_before"]


def test_recluster_touches_only_dirty_partitions(spark):
    path = scratch(spark, "years")
    df = spark.range(400).selectExpr("399 - id AS k", "id % 4 AS y")
    df.repartition(5).write.partitionBy("y").parquet(path)
    files = lambda: {f for f in spark.read.parquet(path).inputFiles()}
    clean = lambda found: {f for f in found if "y=0" in f or "y=1" in f}
    before = files()
    wh.recluster_dirty(spark, path, "y", [2, 3], ["k"], scratch(spark, "staging"))
    assert clean(files()) == clean(before) and not (files() - clean(files())) & before
    assert spark.read.parquet(path).count() == 400
    for f in spark.read.parquet(path).inputFiles():
        if "y=3" in f or "y=2" in f:
            got = [r.k for r in spark.read.parquet(f).collect()]
            assert got == sorted(got)


def test_sorted_layout_lets_files_be_skipped(spark):
    path = scratch(spark, "sorted")
    wh.layout_sort(spark.range(10_000), ["id"], 8).write.parquet(path)
    ranges = sorted((r.lo, r.hi) for r in spark.read.parquet(path).groupBy(
        "_metadata.file_path").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).collect())
    assert len(ranges) > 4
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_load_check(spark):
    got = {r.table_name: r.passed for r in wh.load_check(
        {"a": (spark.range(3), 3), "b": (spark.range(2), 3)}).collect()}
    assert got == {"a": True, "b": False}
