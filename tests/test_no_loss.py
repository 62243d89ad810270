"""Nothing is lost to caps, prefixes, rounding or helper column names."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from plumbline.functions import nested as nst
from plumbline.functions import scalars
from plumbline.operators import profile, recon, relational
from plumbline.operators import warehouse as wh
from plumbline.plans import config
from plumbline.sources import readers, sinks
from plumbline.streaming import streams

ODD_NAMES = ["salt", "rn", "_h", "_n", "_mark", "_tie", "a.b", "a`b", "place", "copies"]


def test_ragged_rows_of_any_width(spark, tmp_path):
    (tmp_path / "in.csv").write_text('g,a,b,c,d\n"x, y","say ""hi""",,z\n\nonly\n')
    got = [r.fields for r in readers.scan_ragged_csv(spark, str(tmp_path / "in.csv")).collect()]
    assert got == [["g", "a", "b", "c", "d"], ["x, y", 'say "hi"', "", "z"], [], ["only"]]


def test_samples_are_cut_before_they_are_collected(spark):
    df = spark.createDataFrame([("r", "c", i) for i in range(9)], "run string, col string, v int")
    got = nst.to_map_of_samples(df, ["run"], "col", 4).first().samples
    assert [x.v for x in got["c"]] == [0, 1, 2, 3]


def test_small_values_survive_a_sum(spark):
    df = spark.range(1000).select(F.lit(0.00001).alias("v"))
    assert df.agg(scalars.exact_sum(F.col("v")).alias("s")).first().s == Decimal("0.0100")


def test_surplus_cells_are_reported(spark):
    df = spark.createDataFrame([("1", "x", None)], "_c0 string, _c1 string, _c2 string")
    got = wh.load_dry_run(df, "id int").collect()
    assert [(r.col_name, r.value, r.reason) for r in got] == [("_c1", "x", "no such column")]


def test_equal_map_columns_are_found(spark):
    df = spark.createDataFrame([({"a": 1}, 2), ({"b": 2}, 3), (None, 4)], "m map<string,int>, k int")
    got = wh.redundant_columns(df.withColumn("n", F.col("m"))).collect()
    assert [tuple(r) for r in got] == [("m", "n")]


def test_lossy_conversions_are_seen(spark):
    df = spark.createDataFrame(
        [("90071992547409.931", 9007199254740993, "2024-01-01 10:00:00", "1.25", 1.5)],
        "d string, b long, t string, s string, f double")
    wanted = {"d": "decimal(16,2)", "b": "double", "t": "date", "s": "decimal(5,1)", "f": "string"}
    got = {r.col_name: (r.misfits, r.changed) for r in wh.type_audit(df, wanted).collect()}
    assert got == {"d": (0, 1), "b": (0, 1), "t": (0, 1), "s": (0, 1), "f": (0, 0)}
    same = spark.createDataFrame([("2.5", 7, "2024-01-01", "1.50", 1.5)], df.schema)
    assert all(r.misfits == r.changed == 0 for r in wh.type_audit(same, wanted).collect())


@pytest.mark.parametrize("name", ODD_NAMES)
def test_helper_columns_spare_user_columns(spark, name):
    df = spark.createDataFrame([(i % 3, i, str(i)) for i in range(30)], "k int, v int, x string")
    given = df.withColumnRenamed("x", name)
    cols = [r.asDict() for r in given.orderBy("v").collect()]

    def same(out):
        return [r.asDict() for r in out.select(given["k"], given["v"], F.col(
            "`" + name.replace("`", "``") + "`")).orderBy("v").collect()] == cols

    by = "`" + name.replace("`", "``") + "`"
    assert wh.layout_key(given, "k", 4, 0.1).columns == given.columns
    assert sorted(map(tuple, wh.layout_key(given, "k", 4, 0.1).collect())) == sorted(
        map(tuple, given.collect()))
    assert sorted(map(tuple, relational.sort_spread(given, "k").collect())) == sorted(
        map(tuple, given.collect()))
    tail = relational.tail_per_key(given, "k", ["v"], 100)
    assert sorted(r[name] for r in tail.collect()) == sorted(r[name] for r in given.collect())
    other = spark.createDataFrame([(i, i * 10) for i in range(3)], "k int, w int")
    joined = relational.salted_join(given, other, "k", [0], salts=3)
    assert joined.count() == 30 and name in joined.columns
    changed = given.withColumn("v", F.when(F.col("v") == 7, 70).otherwise(F.col("v")))
    counts = recon.check_cells(given, changed, [name]).collect()
    assert [tuple(r) for r in counts] == [("v", 1)]
    swapped = given.withColumn(name, F.when(F.col("v") == 7, "new").otherwise(F.col(by)))
    assert [tuple(r) for r in recon.check_cells(given, swapped, ["k", "v"]).collect()] == [(name, 1)]
    assert [r.bad_rows for r in wh.check_pk(given, [name], "r").collect()] == [0]
    assert [r.bad_rows for r in wh.check_not_null(given, [name]).collect()] == [0]
    assert [r.bad_rows for r in wh.check_fk(given, name, given, name, "r").collect()] == [0]


def test_text_widths_without_text(spark):
    assert profile.text_widths(spark.range(3)).collect() == []


def test_saved_options_ignore_case_and_refuse_two_values(spark):
    ddl = config.CONFIG_SCHEMA
    old = spark.createDataFrame([("T", "r", "where", "str", "a", "u")], ddl)
    new = spark.createDataFrame([("t ", "r", "Where", "str", "b", "U")], ddl)
    saved = config.config_save(old, new)
    assert saved.columns == old.columns and saved.count() == 1
    assert config.config_load(saved, "T", "u", {}) == {"where": "b"}
    with pytest.raises(ValueError, match="several"):
        config.config_load(old.unionByName(new.withColumn("left_tbl", F.lit("t"))), "t", "u", {})


def test_ties_in_a_change_log_do_not_depend_on_order(spark, tmp_path):
    rows = [(1, 5, "U", "a"), (1, 5, "U", "b"), (2, 1, "D", "c")]
    ddl = "k int, seq int, op string, v string"
    got = {tuple(map(tuple, streams.newest_changes(
        spark.createDataFrame(r, ddl).coalesce(1), "k", "seq").orderBy("k").collect()))
        for r in (rows, rows[::-1])}
    assert len(got) == 1
    base, log = str(tmp_path / "base"), str(tmp_path / "log")
    spark.createDataFrame([(1, "old"), (2, "gone"), (3, "kept")], "k int, v string").write.parquet(base)
    for batch, row in enumerate(rows):
        spark.createDataFrame([row], ddl).write.parquet(f"{log}/batch={batch}")
    once, twice = str(tmp_path / "n1"), str(tmp_path / "n2")
    assert streams.fold_changes(spark, base, log, once, "k", "seq", "op") == [0, 1, 2]
    streams.fold_changes(spark, base, log, twice, "k", "seq", "op")
    first = sorted(map(tuple, spark.read.parquet(once).collect()))
    assert first == sorted(map(tuple, spark.read.parquet(twice).collect()))
    assert [k for k, _ in first] == [1, 3]


def test_broken_messages_are_set_aside(spark):
    texts = ['{"a": "1"}', '{"a": "x"}', "not json{", '{"a": "2', "", None, "[1]"]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    rows = streams.typed_or_bad(streams.decode_json(df, "value", "a string", "broken"),
                                {"a": "int"}, "broken").collect()
    assert [(r.a, r.bad_columns) for r in rows[:2]] == [(1, ""), (None, "a")]
    assert [r.bad_columns for r in rows[2:]] == ["broken"] * 5
    assert [r.broken for r in rows[2:]] == ["not json{", '{"a": "2', "", "", "[1]"]


def test_compact_keeps_folders_and_order(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    df = spark.range(1000).withColumn("p", F.col("id") % 3)
    df.repartition(8).write.partitionBy("p").parquet(source)
    done = wh.compact(spark, source, target, order=["id"])
    assert done["files_after"] < done["files_before"] and done["rows"] == 1000
    back = spark.read.parquet(target)
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if "=" in p.name) == [
        "p=0", "p=1", "p=2"]
    assert sorted(map(tuple, back.select("id", "p").collect())) == sorted(
        map(tuple, df.collect()))
    empty = str(tmp_path / "e")
    spark.range(3).repartitionByRange(2, "id").filter("id > 5").write.parquet(empty)
    info = wh.table_info(spark.read.parquet(empty)).first()
    assert info.files >= 1 and info["rows"] == 0 and info.bytes > 0


def test_hive_layout_can_run_twice(spark, tmp_path):
    path = str(tmp_path / "h")
    df = spark.range(50).select("id", F.timestamp_seconds(F.col("id") * 1000).alias("ts"))
    for _ in range(2):
        sinks.sink_hive_layout(df, path, "ts")
    assert spark.read.parquet(path).count() == 50


def test_parts_of_a_long_text_are_the_same_in_every_run(spark):
    df = spark.createDataFrame([(i % 2, i * 7 % 100, f"t{i:03}") for i in range(100)],
                               "k int, o int, t string")
    got = []
    for n in ("3", "7"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        rows = relational.ordered_concat(df, ["k"], ["o"], F.col("t"), ",", max_pieces=8)
        got.append(sorted(map(tuple, rows.collect())))
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1] and [p for k, p, _ in got[0] if k == 0] == list(range(7))
    whole = [t for i, t in sorted((i * 7 % 100, f"t{i:03}") for i in range(0, 100, 2))]
    assert ",".join(t for k, _, t in got[0] if k == 0) == ",".join(whole)


def test_upsert_rewrites_only_the_slices_it_names(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(30).selectExpr("id", "id % 3 AS p", "'old' AS v").write.partitionBy("p").parquet(path)
    files = {f for f in tmp_path.rglob("*.parquet") if "p=0" in str(f) or "p=2" in str(f)}
    source = spark.createDataFrame([(1, 1, "new"), (100, 1, "new")], "id long, p int, v string")
    sinks.sink_upsert_slices(spark, path, source, ["id", "p"], "p")
    rows = {r.id: r.v for r in spark.read.parquet(path).collect()}
    assert len(rows) == 31 and {i for i, v in rows.items() if v == "new"} == {1, 100}
    assert files <= set(tmp_path.rglob("*.parquet"))
    with pytest.raises(ValueError, match="partition column"):
        sinks.sink_upsert_slices(spark, path, source, ["id"], "p")
