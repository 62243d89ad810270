"""The physical plans that the operators are meant to get."""

import pytest
from pyspark.sql import functions as F

from plumbline.operators import profile, recon, relational
from plumbline.plans import catalog
from plumbline.plans.derived import pair
from plumbline.session import table
from plumbline.spec import ReconSpec, prepare

catalog.load_all()


@pytest.fixture
def no_broadcast(spark):
    """As at scale: neither side is small enough to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def nodes(text, name):
    """How often an operator stands in the tree (the part before the details)."""
    tree = text.split("\n\n\n")[0]
    return sum(1 for line in tree.splitlines() if f"{name} (" in line)


def test_census_is_one_exchange_with_partial_sums_and_no_join(spark, sf, plan):
    left, right = pair(spark, sf)
    text = plan(recon.key_census(left, right, ["o_orderkey"]))
    assert nodes(text, "Exchange") == 1 and nodes(text, "HashAggregate") == 2
    assert "Join" not in text and "ReadSchema: struct<o_orderkey:bigint>" in text


def test_hash_check_is_two_exchanges(spark, sf, plan):
    text = plan(recon.check_hash(*pair(spark, sf)))
    assert nodes(text, "Exchange") == 2 and "Join" not in text


def test_key_scan_is_one_exchange_of_keys_and_fingerprints(spark, sf, plan):
    left, right = pair(spark, sf)
    findings = recon.scan_keys(left, right, ["o_orderkey"])
    assert findings.totals["differing"] == 49 and findings.differing.count() == 49
    assert findings.totals["rows_left"] == 1500 and findings.repeated.count() == 0


def test_few_differing_keys_are_fetched_without_moving_the_tables(spark, sf, plan):
    """The key list is broadcast into both scans; only its rows are shuffled."""
    left, right = pair(spark, sf)
    tree = plan(recon.cell_diff(left, right, ["o_orderkey"])).split("\n\n\n")[0]
    assert tree.count("BroadcastHashJoin LeftSemi") == 2
    assert "NestedLoop" not in tree and "Cartesian" not in tree


def test_many_differing_keys_join_the_tables_once(spark, sf, plan, no_broadcast, monkeypatch):
    monkeypatch.setattr(recon, "FEW_KEYS", 0)
    left, right = pair(spark, sf)
    text = plan(recon.cell_diff(left, right, ["o_orderkey"]))
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert nodes(text, "SortMergeJoin Inner") == 1 and nodes(text, "Exchange") == 2


def test_with_repeated_keys_every_join_reads_straight_from_a_shuffle(
    spark, sf, plan, no_broadcast, monkeypatch
):
    """Adaptive execution splits a hot key only in a join of two sorted shuffles."""
    monkeypatch.setattr(recon, "FEW_KEYS", 0)
    left, right = pair(spark, sf)
    twice = right.union(right.filter("o_orderkey % 7 = 0"))
    diffs = recon.cell_diff(left.union(left.filter("o_orderkey % 7 = 0")), twice, ["o_orderkey"])
    lines = plan(diffs).split("\n\n\n")[0].splitlines()
    joins = [i for i, line in enumerate(lines) if "SortMergeJoin" in line]
    assert len(joins) > 1
    for i in joins:
        assert ":- Sort" in lines[i + 1] and "Exchange" in lines[i + 2]


@pytest.mark.parametrize("name", [
    "join_pk_diff", "join_anti_nullsafe", "join_semi_hash", "recon_diff_counts", "recon_drilldown",
    "check_fk", "join_multiway", "star_build", "recon_diff_samples", "sales_by_category",
    "buying_patterns", "multi_distinct", "join_salted",
])
def test_no_nested_loops_without_broadcast(spark, sf, plan, no_broadcast, name):
    text = plan(catalog.QUERIES[name](spark, sf))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_unmatched_rows_are_joined_straight_from_shuffles(spark, sf, plan, no_broadcast):
    lines = plan(recon.unmatched_rows(*pair(spark, sf))).splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin LeftSemi" in line)
    assert ":- Sort" in lines[join + 1] and "Exchange" in lines[join + 2]
    right = next(i for i in range(join + 2, len(lines)) if "+- Sort" in lines[i])
    assert "Exchange" in lines[right + 1]


def test_filters_and_columns_reach_the_scan(spark, sf, plan):
    text = plan(catalog.QUERIES["scan_parquet"](spark, sf))
    assert "GreaterThanOrEqual(l_shipdate" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_shipdate" in text
    spec = ReconSpec(where="o_totalprice > 5", exclude=["o_orderpriority", "o_orderdate"])
    text = plan(prepare(table(spark, sf, "orders"), spec, "left"))
    assert "GreaterThan(o_totalprice,5.0)" in text and "o_orderpriority" not in text.split("ReadSchema")[1]
    assert "o_orderdate" in plan(catalog.QUERIES["date_between"](spark, sf)).split("PushedFilters")[1]


def test_top_rows_per_key_are_cut_before_the_shuffle(spark, sf, plan):
    text = plan(relational.tail_per_key(table(spark, sf, "events"), "user_id", ["ts"], 5))
    assert nodes(text, "WindowGroupLimit") == 2


def test_samples_are_cut_before_the_shuffle(spark, sf, plan):
    text = plan(recon.diff_samples(*pair(spark, sf), ["o_orderkey"], 5))
    assert nodes(text, "WindowGroupLimit") == 2


def test_first_rows_use_a_bounded_heap(spark, sf, plan):
    for name in ("sort_all_limit", "take_first", "limit_sample", "recon_drilldown"):
        assert "TakeOrderedAndProject" in plan(catalog.QUERIES[name](spark, sf))


def test_profile_does_not_multiply_rows_by_distinct_aggregates(spark, sf, plan):
    text = plan(profile.profile(table(spark, sf, "orders")))
    assert "Expand" not in text and "Join" not in text


@pytest.mark.parametrize("name", sorted(
    n for n in catalog.QUERIES
    if n.startswith(("recon_", "join_", "profile_", "nested_", "text_", "check_", "config_"))
    or n in ("group_sums", "dup_groups", "tail_per_key", "ordered_concat", "json_extract")))
def test_no_python_in_the_plan(spark, sf, plan, name):
    text = plan(catalog.QUERIES[name](spark, sf))
    for step in ("PythonUDF", "EvalPython", "InPandas", "InArrow"):
        assert step not in text


def test_hot_key_join_is_split_at_run_time(spark, plan, no_broadcast, monkeypatch):
    """One key holds a third of the left rows; adaptive execution splits its partition."""
    monkeypatch.setattr(recon, "FEW_KEYS", 0)
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(90_000).repartition(8).select(
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("v"))
        right = spark.range(90_000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
        diffs = recon.cell_diff(left, right, ["k"])
        rows = diffs.count()
        assert rows == left.join(right, "k").count()
        diffs.write.format("noop").mode("overwrite").save()
        counted = diffs.agg(F.count(F.lit(1)))
        counted.collect()
        assert "skew" in plan(counted).lower()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
