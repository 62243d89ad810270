import pytest
from pyspark.sql import functions as F

from plumbline.functions import nested as nst
from plumbline.functions import scalars
from plumbline.operators import relational, reshape
from plumbline.sources import readers

NESTED = """id int, type_id int, items array<struct<item_type: int, flag: boolean,
            event: array<struct<info1: string>>>>"""


@pytest.fixture
def nested(spark):
    e = [("x",)]
    rows = [
        (1, 1, [(1, False, None), (3, True, e * 2), (3, True, e * 2)]),
        (2, 2, None),
        (3, 1, [(1, False, None), (6, False, e), (6, False, None)]),
        (4, 2, [(1, True, e)]),
        (5, 3, None),
        (6, 3, []),
    ]
    return spark.createDataFrame(rows, NESTED)


def test_null_arrays_count_as_empty(nested):
    got = {r.type_id: tuple(r)[1:] for r in nst.item_rollup(nested, "type_id").collect()}
    assert got == {1: (2, 2, 2, 6, 2, 5), 2: (2, 1, 1, 1, 1, 1), 3: (2, 0, 0, 0, 0, 0)}


def test_json_fields_and_bad_json(spark):
    df = spark.createDataFrame([('{"a": 1, "b": "x"}',), ("{}",), (None,)], "js string")
    got = [(r.a, r.b) for r in nst.json_fields(df, "js", {"a": "int", "b": "string"}).collect()]
    assert got == [(1, "x"), (None, None), (None, None)]


def test_map_of_samples(spark):
    df = spark.createDataFrame([(1, "x", "b"), (1, "x", "a"), (1, "y", "c")],
                               "run int, col string, val string")
    got = nst.to_map_of_samples(df, ["run"], "col", 5).first().samples
    assert {k: [r.val for r in v] for k, v in got.items()} == {"x": ["a", "b"], "y": ["c"]}


def ragged_lines():
    """Four groups with 4, 6, 2 and 3 names, each name holding a comma: 15 names."""
    return [(f"group{g}", [f"name{g},{'abcdef'[i]}" for i in range(n)])
            for g, n in ((1, 4), (2, 6), (3, 2), (4, 3))]


def test_ragged_rows_keep_every_name(spark, tmp_path):
    text = "\n".join(",".join(f'"{x}"' for x in (g, *names)) for g, names in ragged_lines())
    (tmp_path / "in.csv").write_text(text + "\n")
    df = readers.scan_ragged_csv(spark, str(tmp_path / "in.csv"))
    got = {(r.group_name, r.pos, r.name) for r in reshape.explode_ragged(df, "fields").collect()}
    assert got == {(g, i + 1, x) for g, names in ragged_lines() for i, x in enumerate(names)}
    assert len(got) == 15


def test_ragged_rows_keep_empty_quoted_fields(spark, tmp_path):
    (tmp_path / "in.csv").write_text('"g","","b"\n"h"\n')
    df = readers.scan_ragged_csv(spark, str(tmp_path / "in.csv"))
    assert [r.fields for r in df.collect()] == [["g", "", "b"], ["h"]]
    assert reshape.explode_ragged(df, "fields").count() == 2


def quiz(spark, tmp_path):
    head = ["Question", "Kind"] + [f"Answer Option {i}" for i in range(1, 16)] + ["Correct"]
    rows = [["What, exactly?", "single", "one", "two"] + [""] * 13 + ["2"],
            ['Which\nof "these"?', "multi", "p", "q", "r"] + [""] * 11 + ["z", "1, 3, 15"]]
    quote = lambda x: '"' + x.replace('"', '""') + '"'
    (tmp_path / "quiz.csv").write_text("\n".join(",".join(map(quote, r)) for r in [head, *rows]))
    return readers.scan_quoted_csv(spark, str(tmp_path / "quiz.csv"))


def test_quoted_fields_hold_commas_quotes_and_line_breaks(spark, tmp_path):
    assert {r.Question for r in quiz(spark, tmp_path).collect()} == {
        "What, exactly?", 'Which\nof "these"?'}


def test_answers_of_multi_select_questions(spark, tmp_path):
    df = quiz(spark, tmp_path)
    options = reshape.unpivot_options(df, ["Question"], "Answer Option ")
    assert options.count() == 6
    chosen = reshape.split_multiselect(df, ["Question"], "Correct")
    got = {(r.option_no, r.option_text)
           for r in chosen.join(options, ["Question", "option_no"]).collect()}
    assert got == {(2, "two"), (1, "p"), (3, "r"), (15, "z")}


def test_concat_loose_and_setdiff(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, 1.5)], "ID int, b double").withColumnRenamed("ID", "id")
    both = reshape.concat_loose([a, b])
    assert {tuple(r) for r in both.collect()} == {(1, "x", None), (2, None, 1.5)}
    got = {(r.side, r.col_name) for r in reshape.schema_setdiff(spark, a, b).collect()}
    assert got == {("left", "a"), ("right", "b")}


@pytest.mark.parametrize("limit", [50, 400, 5000])
def test_ordered_concat_cuts_long_keys_into_parts_in_order(spark, limit):
    """One key and null hold a third of the rows each; order values repeat."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(
        F.lit("k"), (F.col("id") % 100)))
    df = spark.range(6000).select(key.alias("k"), F.floor(F.col("id") / 4).alias("o"),
                                  F.col("id").cast("string").alias("t"))
    want = {}
    for r in sorted(df.collect(), key=lambda r: (r.o, r.t)):
        want.setdefault(r.k, []).append(r.t)
    mixed = df.repartition(5).orderBy(F.rand())
    got = relational.ordered_concat(mixed, ["k"], ["o"], F.col("t"), ",", max_pieces=limit).collect()
    parts = {}
    for r in sorted(got, key=lambda r: r.part):
        assert len(r.text.split(",")) <= limit
        parts.setdefault(r.k, []).extend(r.text.split(","))
    assert parts == want
    assert all(r.part == 0 for r in got if len(want[r.k]) <= limit)


@pytest.mark.parametrize("day,first", [
    ("2024-03-01", "2024-03-01"), ("2024-03-02", "2024-03-08"), ("2024-12-31", "2025-01-03")])
def test_next_fridays_include_today(spark, day, first):
    got = spark.range(1).select(
        scalars.next_fridays(F.to_date(F.lit(day)), 4).alias("f")).first().f
    assert len(got) == 4 and str(got[0]) == first and all(d.weekday() == 4 for d in got)


def test_latest_per_key_keeps_keys_without_rows(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 3, 7.0), ("a", 2, 9.0)],
                               "k string, ts int, v double")
    keys = spark.createDataFrame([("a",), ("b",)], "k string")
    got = {r.k: r.v for r in relational.latest_per_key(df, "k", ["ts"], "v", keys).collect()}
    assert got == {"a": 7.0, "b": None}


def test_latest_row_fills_missing_fields(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None)], "k string, ts int, v string")
    got = relational.latest_row(df, "k", ["ts"], {"v": F.lit("N/A")}).collect()
    assert [tuple(r) for r in got] == [("a", "N/A")]


def test_delete_where_keeps_rows_with_unknown_predicate(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "v int")
    assert {r.v for r in relational.delete_where(df, "v > 3").collect()} == {1, None}


def test_upsert(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    s = spark.createDataFrame([(2, "B"), (3, "c"), (None, "m")], "k int, v string")
    got = {tuple(r) for r in relational.upsert(t, s, ["k"], check=True).collect()}
    assert got == {(1, "a"), (2, "B"), (3, "c"), (None, "n"), (None, "m")}
    with pytest.raises(ValueError, match="several rows"):
        relational.upsert(t, s.union(s), ["k"], check=True)


def test_bad_values_become_null_when_retyped(spark):
    df = spark.createDataFrame([("1", "x"), ("z", "2024-01-02")], "a string, b string")
    got = [tuple(r) for r in relational.retype(df, [(1, "day", "date"), (0, "n", "int")]).collect()]
    assert [(n, str(d) if d else None) for n, d in got] == [(1, None), (None, "2024-01-02")]


def test_regex_match_with_unknown_value_is_false(spark):
    df = spark.createDataFrame([("bigint", "int"), ("int", "int"), (None, "x"), ("x", None)],
                               "v string, p string")
    got = df.select(scalars.matches(F.col("v"), F.col("p")),
                    scalars.matches(F.col("v"), F.col("p"), whole=True)).collect()
    assert [tuple(r) for r in got] == [(True, False), (True, True), (False, False), (False, False)]


def test_field_of(spark):
    df = spark.createDataFrame([("  a b\tc",), ("",), ("one",)], "l string")
    got = df.select(reshape.field_of(F.col("l"), 1), reshape.field_of(F.col("l"), 3)).collect()
    assert [tuple(r) for r in got] == [("a", "c"), ("", ""), ("one", "")]
