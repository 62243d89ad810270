import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from plumbline.session import scratch
from plumbline.sources import jdbc, readers, sinks


def test_scratch_is_under_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch(spark, "x"), scratch(spark, "x")
    assert a.startswith(root) and a != b


def test_delimited_gzip(spark, tmp_path):
    with gzip.open(tmp_path / "a.tbl.gz", "wt") as f:
        f.write("1|x|2.50\n2||\n")
    df = readers.scan_delimited(spark, str(tmp_path), "id int, name string, price decimal(18,4)")
    assert [(r.id, r.name, r.price and float(r.price)) for r in df.collect()] == [
        (1, "x", 2.5), (2, None, None)]


def test_manifest_reads_exactly_its_files(spark, tmp_path):
    for name in "abc":
        (tmp_path / f"{name}.tbl").write_text(f"{ord(name)}|{name}\n")
    wanted = [{"url": str(tmp_path / f"{n}.tbl"), "mandatory": True} for n in "ac"]
    (tmp_path / "load.manifest").write_text(json.dumps({"entries": wanted}, indent=1))
    df = readers.scan_manifest(spark, str(tmp_path / "load.manifest"), "id int, name string")
    assert {r.name for r in df.collect()} == {"a", "c"}


def test_manifest_with_a_missing_file_fails(spark, tmp_path):
    wanted = [{"url": str(tmp_path / "no.tbl"), "mandatory": True}]
    (tmp_path / "load.manifest").write_text(json.dumps({"entries": wanted}))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.scan_manifest(spark, str(tmp_path / "load.manifest"), "id int").count()


def test_json_keys_in_any_case(spark, tmp_path):
    (tmp_path / "in.json").write_text('{"Uuid": "a", "UNITS": 5}\n{"uuid": "b"}\n{"uuid":1,"UUID":2}\n')
    df = readers.scan_json_mapped(spark, str(tmp_path / "in.json"), ["uuid", "Units"])
    assert [tuple(r) for r in df.collect()] == [("a", "5"), ("b", None), ("2", None)]
    assert df.columns == ["uuid", "units"]


def test_crawl_merges_columns_and_finds_partitions(spark, tmp_path):
    p = str(tmp_path / "set")
    spark.range(2).withColumn("a", F.lit(1)).write.parquet(f"{p}/day=1")
    spark.range(2).withColumn("b", F.lit("x")).write.parquet(f"{p}/day=2")
    got = {(r.table_name, r.col_name, r.data_type, r.is_partition)
           for r in readers.crawl(spark, {"set": p}, prefix="raw_", register=True).collect()}
    assert got == {("raw_set", "id", "bigint", False), ("raw_set", "a", "int", False),
                   ("raw_set", "b", "string", False), ("raw_set", "day", "int", True)}
    assert spark.table("raw_set").count() == 4
    spark.sql("DROP TABLE raw_set")


def test_managed_table_is_created_once(spark, tmp_path):
    name = readers.unique_name("lake")
    for _ in range(2):
        readers.managed_table(spark, name, "id int", location=str(tmp_path / "lake"))
        spark.createDataFrame([(1,)], "id int").write.insertInto(name)
    assert spark.table(name).count() == 2


def test_replacing_a_slice_keeps_the_others(spark, tmp_path):
    p = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "part string, v int")
    df.write.partitionBy("part").parquet(p)
    sinks.sink_replace_slice(spark.createDataFrame([("b", 3)], "part string, v int"), p, "part")
    assert {tuple(r) for r in spark.read.parquet(p).select("part", "v").collect()} == {
        ("a", 1), ("b", 3)}


def test_hive_layout_folders_and_pruning(spark, tmp_path, plan):
    p = str(tmp_path / "lake")
    df = spark.sql("""SELECT id, TIMESTAMP_NTZ '2024-01-31 22:30:00' + make_dt_interval(0, id) AS ts
                      FROM range(4)""")
    sinks.sink_hive_layout(df, p, "ts")
    assert os.path.isdir(f"{p}/year=2024/month=2/day=1/hour=0")
    night = spark.read.parquet(p).filter("month = 2 AND hour = 0")
    assert night.count() == 1
    assert "PartitionFilters: [isnotnull(month" in plan(night)


def test_swap_and_upsert_a_table(spark, tmp_path):
    name = readers.unique_name("orders")
    sinks.sink_overwrite(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), name,
                         str(tmp_path / "old"))
    new = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    sinks.sink_upsert(spark, name, new, ["k"], str(tmp_path / "new"))
    assert {tuple(r) for r in spark.table(name).collect()} == {(1, "a"), (2, "B"), (3, "c")}


def test_overwrite_may_change_the_schema(spark, tmp_path):
    name = readers.unique_name("t")
    sinks.sink_overwrite(spark.range(2), name, str(tmp_path / "t"))
    sinks.sink_overwrite(spark.range(3).selectExpr("id AS k", "'x' AS v"), name, str(tmp_path / "t"))
    assert spark.table(name).columns == ["k", "v"] and spark.table(name).count() == 3


def test_partitioned_sink_writes_sorted_files(spark, tmp_path):
    name = readers.unique_name("p")
    df = spark.range(1000).selectExpr("id % 2 AS part", "999 - id AS v")
    sinks.sink_partitioned(df, name, "part", ["part", "v"], str(tmp_path / "p"))
    for f in spark.table(name).inputFiles():
        got = [r.v for r in spark.read.parquet(f).collect()]
        assert got == sorted(got)
    assert spark.table(name).count() == 1000


def test_csv_keeps_blanks_and_quotes(spark, tmp_path):
    rows = [(" a ", 'say "hi"'), ("x,y", "line\nbreak")]
    df = spark.createDataFrame(rows, "a string, b string")
    sinks.sink_csv(df, str(tmp_path / "c"))
    back = readers.scan_quoted_csv(spark, str(tmp_path / "c"), df.schema)
    assert {tuple(r) for r in back.collect()} == set(rows)


def test_jdbc_read_options():
    opts = jdbc.read_options("jdbc:x", "t", "id", (0, 100), 4)
    assert (opts["partitionColumn"], opts["lowerBound"], opts["upperBound"],
            opts["numPartitions"]) == ("id", "0", "100", "4")
    assert "partitionColumn" not in jdbc.read_options("jdbc:x", "t")
    with pytest.raises(ValueError, match="bound"):
        jdbc.read_options("jdbc:x", "t", "id")


def test_sales_json_is_gzipped_and_read_whole(spark, sf):
    from plumbline.plans.derived import SALES_COLUMNS, sales
    from plumbline.plans.q_sources import sales_json

    path = sales_json(spark, sf)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert files and all(f.endswith(".json.gz") for f in files)
    got, want = readers.scan_json_mapped(spark, path, SALES_COLUMNS), sales(spark, sf)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
