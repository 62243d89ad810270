import itertools
import random

import pytest
from pyspark.sql import functions as F

from plumbline.functions.canonical import row_fingerprint, row_hash_hex
from plumbline.operators import recon
from plumbline.plans import report
from plumbline.plans.derived import pair
from plumbline.spec import ReconSpec, SpecError, TableSpec, precheck, prepare

KEYS = ["o_orderkey"]


@pytest.fixture(scope="module")
def sides(spark, sf):
    return pair(spark, sf)


def frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


# --- seeded defects ---------------------------------------------------------------------

def test_seeded_defects_are_found_exactly(sides):
    res = report.reconcile(*sides, ReconSpec(keys=KEYS, samples=3))
    assert res.metrics["counts"] == {"left": 1500, "right": 1495}
    assert res.metrics["exclusive_keys"] == {"left": 16, "right": 4}
    assert (res.metrics["dup_keys"]["left"], res.metrics["dup_keys"]["right"]) == (0, 7)
    assert res.metrics["cells"] == {"o_orderstatus": 21, "o_totalprice": 28}
    assert (res.metrics["hash"]["row_diff"], res.metrics["hash"]["only_right"]) == (65, 53)
    assert res.checks["schema"] and not res.passed
    assert res.samples.groupBy("col_name").count().collect()[0]["count"] == 3


def test_a_table_equals_itself(sides):
    left, _ = sides
    res = report.reconcile(left, left, ReconSpec(keys=KEYS))
    assert res.passed and all(res.checks.values())


def test_swapping_sides_swaps_results(sides):
    a = report.reconcile(*sides, ReconSpec(keys=KEYS)).metrics
    b = report.reconcile(*reversed(sides), ReconSpec(keys=KEYS)).metrics
    assert a["counts"]["left"] == b["counts"]["right"]
    assert a["exclusive_keys"]["left"] == b["exclusive_keys"]["right"]
    assert a["hash"]["row_diff"] == b["hash"]["only_right"]
    assert a["cells"] == b["cells"]


def test_partitioning_and_row_order_do_not_matter(sides):
    left, right = sides
    a = report.reconcile(left, right, ReconSpec(keys=KEYS)).rows()
    b = report.reconcile(
        left.repartition(7, "o_custkey"), right.orderBy(F.desc("o_totalprice")), ReconSpec(keys=KEYS)
    ).rows()
    assert sorted(a) == sorted(b)


def test_stop_on_first_failure(sides):
    with pytest.raises(report.CheckFailed, match="counts"):
        report.reconcile(*sides, ReconSpec(keys=KEYS, stop_on_failure=True))


def test_plans_are_returned_on_request(sides):
    res = report.reconcile(*sides, ReconSpec(keys=KEYS, include_plans=True))
    assert set(res.plans) == {"hash", "cells"} and "HashAggregate" in res.plans["hash"]
    some = ReconSpec(keys=KEYS, include_plans=True, checks=["counts"])
    assert set(report.reconcile(*sides, some).plans) == {"census"}


def test_only_chosen_checks_run(sides):
    res = report.reconcile(*sides, ReconSpec(checks=["counts"]))
    assert list(res.checks) == ["counts"] and not res.passed


def test_without_keys_the_hash_check_gives_samples(sides):
    res = report.reconcile(*sides, ReconSpec(samples=4))
    assert "dup_keys" not in res.checks and res.samples.count() == 4


# --- preparing a side -------------------------------------------------------------------

def test_milliseconds_are_hidden_by_default_and_seen_without(spark):
    base = spark.sql("SELECT 1 AS id, TIMESTAMP_NTZ '2024-01-01 10:00:00' AS ts")
    late = spark.sql("SELECT 1 AS id, TIMESTAMP_NTZ '2024-01-01 10:00:00.123456' AS ts")
    assert report.reconcile(base, late, ReconSpec(keys=["id"])).passed
    assert not report.reconcile(base, late, ReconSpec(keys=["id"], type_exprs={})).passed


def test_renamed_column_takes_part_in_every_check(sides):
    left, right = sides
    spec = ReconSpec(keys=KEYS, rename={"ORDER_ID": "o_orderkey"})
    res = report.reconcile(left, right.withColumnRenamed("o_orderkey", "order_id"), spec)
    assert res.metrics["schema"] == {"left_cols": 6, "right_cols": 6, "mismatched": 0}
    assert res.metrics["exclusive_keys"] == {"left": 16, "right": 4}


def test_column_expression_runs_before_type_expression(spark):
    df = frame(spark, [(1, 2.26)], "id int, v double")
    spec = ReconSpec(column_exprs={"V": "{col} + 1"}, type_exprs={"double": "round({col}, 1)"})
    assert prepare(df, spec, "left").first().v == 3.3


def test_filter_sees_raw_columns(spark):
    df = frame(spark, [(1, "a"), (2, "b")], "Id int, T string")
    spec = ReconSpec(where="T = 'a'", exclude=["t"], column_exprs={"id": "{col} * 10"})
    assert [tuple(r) for r in prepare(df, spec, "left").collect()] == [(10,)]


def test_precheck(sides):
    left, right = sides
    with pytest.raises(SpecError, match="keys"):
        report.reconcile(left, right, ReconSpec(keys=["no_such"]))
    with pytest.raises(SpecError, match="only left"):
        precheck(left, right.drop("o_custkey"), ReconSpec())
    with pytest.raises(SpecError, match="keys"):
        report.reconcile(left, right, ReconSpec(keys=KEYS, exclude=KEYS))


@pytest.mark.parametrize("bad", [
    {"keys": "id"}, {"samples": -1}, {"samples": True}, {"where": 1}, {"checks": ["nope"]},
    {"no_such_option": 1}, {"stop_on_failure": "yes"}, {"rename": ["a"]},
    {"rename": {"a": "x", "b": "X"}},
])
def test_bad_options_are_rejected(bad):
    with pytest.raises((SpecError, TypeError)):
        ReconSpec.from_options(bad)


def test_options_ignore_case():
    spec = ReconSpec.from_options({"keys": ["ID "], "rename": {"A": "B"}, "column_exprs": {"C": "x"}})
    assert (spec.keys, spec.rename, spec.column_exprs) == (("id",), {"a": "b"}, {"c": "x"})


def test_table_spec(spark):
    spec = TableSpec.of(frame(spark, [], "Id bigint, V decimal(10,2)"))
    assert spec.names == ["id", "v"] and spec.type_of("V") == "decimal(10,2)"


def test_json_key_order_is_ignored_on_request(spark):
    a = frame(spark, [(1, '{"x":1,"y":"b"}')], "id int, js string")
    b = frame(spark, [(1, '{"y":"b", "x":1}')], "id int, js string")
    assert not report.reconcile(a, b, ReconSpec(keys=["id"])).passed
    assert report.reconcile(a, b, ReconSpec(keys=["id"], sort_json=["js"])).passed


# --- behaviour that differs on purpose --------------------------------------------------

def test_schema_check_fails_when_every_column_mismatches(spark):
    a, b = frame(spark, [], "x int, y int"), frame(spark, [], "x string, y string")
    found = recon.check_schema(spark, a.schema, b.schema).collect()
    assert len(found) == 2 and not any(r.matched for r in found)


def test_type_rules_match_whole_names_once(spark):
    a, b = frame(spark, [], "x bigint"), frame(spark, [], "x decimal(38,0)")
    assert [r.matched for r in recon.check_schema(spark, a.schema, b.schema).collect()] == [True]


@pytest.mark.parametrize("left,right,ok", [
    ("double", "decimal(18,2)", True), ("double", "decimal(18,3)", False),
    ("timestamp_ntz", "timestamp", True), ("timestamp", "timestamp_ntz", False),
    ("decimal(10,2)", "decimal(38,2)", True), ("decimal(10,2)", "decimal(38,0)", False),
    ("int", "bigint", False), ("int", "decimal(5,0)", True),
])
def test_type_pairs(spark, left, right, ok):
    a, b = frame(spark, [], f"x {left}"), frame(spark, [], f"x {right}")
    assert recon.check_schema(spark, a.schema, b.schema).first().matched is ok


def test_one_sided_columns_are_reported(spark):
    found = recon.check_schema(spark, frame(spark, [], "x int").schema,
                               frame(spark, [], "y int").schema)
    assert {(r.col_name, r.matched) for r in found.collect()} == {("x", False), ("y", False)}


@pytest.fixture(params=["text hash", "fingerprint"])
def distinct(request):
    """Number of rows that the hash tells apart."""
    def count(df):
        cols = [row_hash_hex(df)] if request.param == "text hash" else row_fingerprint(df)
        return df.select(*cols).distinct().count()
    return count


def test_null_position_and_separators_change_the_hash(spark, distinct):
    rows = [("a", None), (None, "a"), ("a||b", "c"), ("a", "b||c"), ("", None), (None, ""),
            ("~", None), ("1:a", "b"), ("1", ":ab"), (None, None), ("", "")]
    assert distinct(frame(spark, rows, "x string, y string")) == len(rows)


def test_equal_values_have_equal_hashes(spark, distinct):
    df = frame(spark, [(0.0, float("nan")), (-0.0, float("nan"))], "x double, y double")
    assert distinct(df) == 1


def test_values_inside_nested_columns_count(spark, distinct):
    df = spark.sql("""SELECT array(TIMESTAMP_NTZ '2024-01-01 00:00:00.000001') AS a
                      UNION ALL SELECT array(TIMESTAMP_NTZ '2024-01-01 00:00:00.000002')""")
    assert distinct(df) == 2
    df = frame(spark, [([1, None],), ([None, 1],), ([1],), ([],), (None,)], "a array<int>")
    assert distinct(df) == 5


def test_map_entry_order_does_not_count(spark, distinct):
    df = spark.sql("SELECT map('a', 1, 'b', 2) AS m UNION ALL SELECT map('b', 2, 'a', 1)")
    assert distinct(df) == 1


def test_copies_are_compared(spark):
    a = frame(spark, [(1,), (1,), (2,)], "x int")
    b = frame(spark, [(1,), (2,), (2,)], "x int")
    assert recon.check_hash(a, b).first().asDict() == {
        "row_diff": 0, "only_right": 0, "copies_differ": 2}


def test_allowed_type_pairs_compare_by_value(sides):
    left, right = sides
    other = left.select(
        F.col("o_orderkey").cast("decimal(38,0)").alias("o_orderkey"), "o_custkey", "o_orderstatus",
        F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
        F.col("o_orderdate").cast("timestamp").alias("o_orderdate"), "o_orderpriority")
    res = report.reconcile(left, other, ReconSpec(keys=KEYS))
    assert res.passed and all(res.checks.values())
    assert recon.unmatched_rows(left, other).count() == 0
    assert recon.unmatched_rows(left, right).schema == left.schema


def test_text_against_numbers_compares_as_text(spark):
    a = frame(spark, [(1, 5), (2, 6)], "k int, v int")
    b = frame(spark, [(1, "5"), (2, "x")], "k int, v string")
    got = {r.col_name: r.mismatch_cnt for r in recon.check_cells(a, b, ["k"]).collect()}
    assert got == {"v": 1} and recon.check_hash(a, b).first().row_diff == 1


def test_key_only_tables(spark):
    a, b = frame(spark, [(1,), (2,)], "k int"), frame(spark, [(2,), (3,)], "k int")
    res = report.reconcile(a, b, ReconSpec(keys=["k"]))
    assert res.metrics["exclusive_keys"] == {"left": 1, "right": 1} and res.checks["cells"]


# --- null keys and keys repeated on both sides, against brute force ----------------------

def brute(left, right, n_keys):
    """Differing pairs per column over all pairs with equal keys."""
    n_cols = len(left[0]) - n_keys
    counts = [0] * n_cols
    samples = [set() for _ in range(n_cols)]
    for a, b in itertools.product(left, right):
        if a[:n_keys] != b[:n_keys]:
            continue
        for i in range(n_cols):
            if a[n_keys + i] != b[n_keys + i]:
                counts[i] += 1
                samples[i].add((a[:n_keys], a[n_keys + i], b[n_keys + i]))
    return counts, samples


@pytest.mark.parametrize("few", [0, 1000])
@pytest.mark.parametrize("seed", range(4))
def test_cells_match_brute_force(spark, seed, few, monkeypatch):
    monkeypatch.setattr(recon, "FEW_KEYS", few)
    rnd = random.Random(seed)
    val = lambda: rnd.choice(["a", "b", "c", None])
    key = lambda: rnd.choice([None, 1, 2, 3, 4, 5, 6])
    left = [(key(), rnd.choice([None, "k"]), val(), val()) for _ in range(rnd.randint(1, 25))]
    right = [(key(), rnd.choice([None, "k"]), val(), val()) for _ in range(rnd.randint(1, 25))]
    ddl, keys = "k1 int, k2 string, x string, y string", ["k1", "k2"]
    lhs, rhs = frame(spark, left, ddl), frame(spark, right, ddl)
    counts, samples = brute(left, right, 2)
    got = {r.col_name: r.mismatch_cnt for r in recon.check_cells(lhs, rhs, keys).collect()}
    assert got == {c: n for c, n in zip("xy", counts) if n}

    order = lambda t: tuple((v is not None, v) for v in (*t[0], t[1], t[2]))
    for n in (1, 3):
        picked = recon.diff_samples(lhs, rhs, keys, n).collect()
        for i, c in enumerate("xy"):
            want = sorted(samples[i], key=order)[:n]
            have = sorted((((r.k1, r.k2), r.left_val, r.right_val) for r in picked
                           if r.col_name == c), key=order)
            assert have == want


@pytest.mark.parametrize("seed", range(3))
def test_key_checks_match_brute_force(spark, seed):
    rnd = random.Random(100 + seed)
    left = [(rnd.choice([None, 1, 2, 3, 4, 5]),) for _ in range(12)]
    right = [(rnd.choice([None, 3, 4, 5, 6, 7]),) for _ in range(12)]
    lhs, rhs = frame(spark, left, "k int"), frame(spark, right, "k int")
    dup = {r.side: r.dup_keys for r in recon.check_dup_keys(lhs, rhs, ["k"]).collect()}
    only = {r.side: r.exclusive_rows for r in recon.check_exclusive_keys(lhs, rhs, ["k"]).collect()}
    assert dup == {s: sum(1 for k in set(t) if t.count(k) > 1)
                   for s, t in (("left", left), ("right", right))}
    assert only == {"left": sum(k not in right for k in left),
                    "right": sum(k not in left for k in right)}


def test_a_hot_key_on_both_sides_is_counted_without_pairs(spark):
    """A third of the rows share one key: 100 million pairs, counted from 20,000 values."""
    n = 30_000
    key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k")
    left = spark.range(n).select(key, (F.col("id") % 5).alias("v"))
    right = spark.range(n).select(key, (F.col("id") % 7).alias("v"))
    got = {r.col_name: r.mismatch_cnt for r in recon.check_cells(left, right, ["k"]).collect()}
    hot = [i for i in range(n) if i % 3 == 0]
    lv = [sum(1 for i in hot if i % 5 == v) for v in range(7)]
    rv = [sum(1 for i in hot if i % 7 == v) for v in range(7)]
    pairs = len(hot) ** 2 - sum(a * b for a, b in zip(lv, rv))
    single = sum(1 for i in range(n) if i % 3 and i % 5 != i % 7)
    assert got == {"v": pairs + single}


def test_drilldown_shows_absent_keys_as_nulls(spark):
    left = frame(spark, [(1, "a"), (2, "b"), (2, "c")], "k int, v string")
    right = frame(spark, [(2, "d")], "k int, v string")
    wrong = frame(spark, [(1,), (2,), (2,)], "k int")
    got = [tuple(r) for r in report.drilldown(wrong, left, right, ["k"], ["k", "v"]).collect()]
    assert got == [("left", 1, "a"), ("left", 2, "b"), ("left", 2, "c"), ("right", None, None),
                   ("right", 2, "d")]


def test_guess_join_columns():
    names = ["event_dt", "v", "A_ID", "x_id", "y_id", "z_id"]
    assert report.guess_join_columns(names) == ["event_dt", "A_ID", "x_id", "y_id", "z_id"]


# --- many pairs -------------------------------------------------------------------------

def test_a_failing_pair_does_not_stop_the_rest(spark, sides):
    left, right = sides
    pairs = [report.Pair("a", "b", left, "no_such_table", ReconSpec(keys=KEYS)),
             report.Pair("a", "c", left, right, ReconSpec(keys=KEYS, samples=2))]
    rows = report.reconcile_many(spark, pairs).collect()
    assert rows[0].comments.startswith("ERROR") and rows[0].passed is False
    assert set(rows[1].mismatched_rows) == {"o_orderstatus", "o_totalprice"}
    assert len(rows[1].mismatched_rows["o_totalprice"]) == 2
    assert len(rows[1]) == 19


def test_verdict():
    ok = {"hash": True, "schema": True, "counts": True}
    assert report.verdict(ok, has_keys=False)
    assert not report.verdict(ok, has_keys=True)
    assert report.verdict({**ok, "cells": True}, has_keys=True)
    assert not report.verdict({**ok, "hash": False, "cells": True}, has_keys=True)


def test_hash_totals_of_the_key_scan_equal_the_hash_check(spark):
    """Random sides with repeated, one-sided, null and unequal keys."""
    import random

    draw = random.Random(8)
    for _ in range(4):
        side = lambda n: spark.createDataFrame(
            [(draw.choice([None, 1, 2, 3, 4, 5, 6]), draw.choice(["a", "b", None]))
             for _ in range(n)], "k int, v string")
        left, right = side(draw.randint(0, 14)), side(draw.randint(0, 14))
        found = recon.scan_keys(left, right, ["k"])
        want = recon.check_hash(left, right).first().asDict()
        assert recon.hash_differences(left, right, found) == want
        rows = recon.fetch(left, right, found)
        assert recon.hash_differences(*rows, found) == want
        assert sorted(map(tuple, recon.check_cells(left, right, ["k"]).collect())) == sorted(
            map(tuple, recon.check_cells(left, right, ["k"], found).collect()))


def test_each_side_is_read_twice_at_most(spark):
    """A whole report with unequal, repeated and tangled keys; the sides count the rows they give."""
    from plumbline.plans import report
    from plumbline.spec import ReconSpec

    sides, reads = [], []
    for k in range(2):
        seen = spark.sparkContext.accumulator(0)

        def count(batches, seen=seen):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        rows = spark.range(0, 400).selectExpr(
            "id AS k", f"if(id % 50 = {k}, 'x', 'y') AS v", "id % 7 AS w").union(
            spark.range(0, 20).selectExpr("id % 3 AS k", "'z' AS v", "id AS w"))
        sides.append(rows.mapInArrow(count, rows.schema))
        reads.append(seen)
    result = report.reconcile(*sides, ReconSpec(keys=["k"], samples=3))
    assert not result.passed and result.metrics["hash"]["row_diff"] > 0
    assert [n.value for n in reads] == [2 * 420, 2 * 420]
