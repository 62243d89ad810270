"""Columns whose names the operators use themselves, or that hold dots."""

from decimal import Decimal

from pyspark.sql import functions as F

from plumbline.functions import nested
from plumbline.operators import relational as rel
from plumbline.operators import warehouse as wh
from plumbline.plans import config
from plumbline.streaming import streams


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upsert_on_dotted_keys(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "`a.b` int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C"), (None, "d")], "`a.b` int, v string")
    assert rows(rel.upsert(old, new, ["a.b"], check=True)) == sorted(
        [(1, "a"), (2, "B"), (3, "C"), (None, "c"), (None, "d")], key=str)


def test_latest_on_dotted_and_own_names(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "`a.b` int, `o.p` int, `_r` string")
    assert rows(rel.latest_per_key(df, "a.b", ["o.p"], "_r")) == [(1, "y")]
    keys = spark.createDataFrame([(1, "m"), (5, "n")], "`a.b` int, `c.d` string")
    assert rows(rel.latest_per_key(df, "a.b", ["o.p"], "_r", keys)) == [(1, "m", "y"), (5, "n", None)]
    assert rel.latest_per_key(df, "a.b", ["o.p"], "_r", keys).columns == ["a.b", "c.d", "_r"]
    assert rows(rel.latest_row(df.withColumnRenamed("a.b", "k"), "_r", ["o.p"],
                               {"k": F.lit(0)})) == [("x", 1), ("y", 1)]


def test_zero_filled_counts_by_row_count(spark):
    df = spark.createDataFrame([(1,), (1,)], "row_count int")
    wanted = spark.createDataFrame([(1,), (2,)], "row_count int")
    out = rel.zero_filled_counts(df, "row_count", wanted)
    assert out.columns == ["row_count", "row_count_"] and rows(out) == [(1, 2), (2, 0)]
    dotted = rel.zero_filled_counts(df.toDF("a.b"), "a.b", wanted.toDF("a.b"))
    assert rows(dotted) == [(1, 2), (2, 0)]


def test_defaults_and_json_fields(spark):
    df = spark.createDataFrame([(None, '{"x": 1}', "mine")], "`a.b` int, `j.s` string, `_json` string")
    assert rows(wh.apply_default(df, {"a.b": 7})) == [(7, '{"x": 1}', "mine")]
    assert rows(nested.json_fields(df, "j.s", {"x": "int"})) == [(None, '{"x": 1}', "mine", 1)]
    samples = spark.createDataFrame([("g", "k", 1), ("g", "k", 2)], "`a.b` string, key string, rows int")
    assert rows(nested.to_map_of_samples(samples, ["a.b"], "key", 1))[0][0] == "g"


def test_json_after_any_white_space(spark):
    texts = ['{"a":"1"}', '\n{"a":"2"}', '\t {"a":"3"}', '\r\n{"a":"4"}', "[1]", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    found = {(r.a, r.bad) for r in streams.decode_json(df, "value", "a string", "bad").collect()}
    assert found == {("1", None), ("2", None), ("3", None), ("4", None), (None, "[1]"), (None, "x"),
                     (None, "")}


def test_saved_names_in_any_case_are_one_row(spark):
    cfg = spark.createDataFrame(
        [("T", "s", "Keys", "list", '["old"]', "U"),
         ("t ", "s", "cfg_json", "str", '{"keys":["id"]}', "u")], config.CONFIG_SCHEMA)
    out = config.config_json_to_rows(cfg, ["keys"])
    assert config.config_load(out, "t", "u", {})["keys"] == ["id"]


def test_type_audit_sees_small_losses(spark):
    df = spark.createDataFrame(
        [(1e-11, "1.00000000004", Decimal("0.1"), 2**53 + 1, "0.0000000000000000001"),
         (0.25, "1.5", Decimal("0.5"), 4, "1e-3"), (None, None, None, None, None)],
        "d double, t string, m decimal(20,10), n long, z string")
    wanted = {"d": "decimal(12,2)", "t": "decimal(12,2)", "m": "decimal(12,1)", "n": "double",
              "z": "decimal(12,3)"}
    found = {r.col_name: (r.misfits, r.changed) for r in wh.type_audit(df, wanted).collect()}
    assert found == {"d": (0, 1), "t": (0, 1), "m": (0, 0), "n": (0, 1), "z": (0, 1)}
