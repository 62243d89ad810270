"""Lines and quoted records of files that several tasks read, and cells between separators."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from plumbline.functions import scalars
from plumbline.operators import warehouse as wh
from plumbline.sources import lines, readers


@pytest.fixture
def small_splits(spark):
    """Splits of some hundred bytes."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(k) for k in keys]
    for k, v in zip(keys, ("200", "1"), strict=True):
        spark.conf.set(k, v)
    yield
    for k, v in zip(keys, old, strict=True):
        spark.conf.set(k, v)


def messy(n, seed):
    draw = random.Random(seed)
    cell = lambda: draw.choice(
        ["", "plain", '"in, quotes"', '"two\nlines"', '"a ""quote"" and\n\nmore"', '""', "é", '"\n"',
         '"' + "long " * 90 + '"'])
    return "a,b,c\n" + "".join(f"{i},{cell()},{cell()}\n" for i in range(n))


def test_split_records_equal_whole_files(spark, tmp_path, small_splits):
    for seed in range(2):
        for end in ("\n", ""):
            (tmp_path / f"{seed}{len(end)}.csv").write_text(messy(80, seed).rstrip("\n") + end)
    schema = "a int, b string, c string"
    path = str(tmp_path)
    assert spark.read.text(path).rdd.getNumPartitions() > 20
    key = lambda r: (r.a, str(r.b), str(r.c))
    got = sorted(lines.scan_quoted_split(spark, path, schema).collect(), key=key)
    want = sorted(readers.scan_quoted_csv(spark, path, schema).collect(), key=key)
    assert got == want and len(got) == 320


def test_line_numbers(spark, tmp_path, small_splits):
    texts = {"x.txt": [f"line {i} " + "z" * (i % 40) for i in range(300)], "y.txt": ["one", "", "3"]}
    for name, rows in texts.items():
        (tmp_path / name).write_text("\n".join(rows) + "\n")
    for r in lines.numbered_lines(spark, str(tmp_path)).collect():
        assert texts[r.file.rsplit("/", 1)[1]][r.line_no - 1] == r.line
        assert r.record == r.line_no and r.opens and r.closes


def test_nothing_between_separators_is_lost(spark, tmp_path):
    rows = {'g,"a"b,c': ["g", '"a"b', "c"], 'g, "x,y",z': ["g", ' "x,y"', "z"],
            '"a ""b""",': ['a "b"', ""], 'open"quote,x': ['open"quote', "x"], "": [], ",": ["", ""],
            '"' + 'long, ""text"" ' * 5000 + '",x': ['long, "text" ' * 5000, "x"]}
    (tmp_path / "in.csv").write_text("\n".join(rows) + "\n")
    got = [r.fields for r in readers.scan_ragged_csv(spark, str(tmp_path / "in.csv")).collect()]
    assert got == list(rows.values())


def test_dry_run_reports_every_line(spark, tmp_path, small_splits):
    text = ["1,a"] * 40 + ["2,b,EXTRA", "3", "x,c", '4,"two\nlines",more,even more', ",d"]
    (tmp_path / "in.csv").write_text("\n".join(text) + "\n")
    found = wh.load_dry_run_lines(spark, str(tmp_path), "k int not null, v string")
    got = sorted((r.line_no, str(r.col_name), str(r.value), r.reason) for r in found.collect())
    assert got == [
        (41, "None", "EXTRA", "no such column"), (42, "v", "None", "record ends early"),
        (43, "k", "x", "not a int"), (44, "None", "even more", "no such column"),
        (44, "None", "more", "no such column"), (46, "k", "None", "missing")]


def test_sums_of_small_and_large_values(spark):
    total = lambda values: spark.createDataFrame(
        [(v,) for v in values], "v double").agg(scalars.exact_sum(F.col("v"), 16).alias("s")).first().s
    assert total([1e-13] * 1000) == Decimal("1e-10")
    assert total([0.1] * 10 + [None]) == Decimal(1)
    assert total([1234.56789, -0.00001]) == Decimal("1234.56788")
    big = spark.createDataFrame([(1e17,), (0.25,)], "v double").agg(
        scalars.exact_sum(F.col("v")).alias("s")).first().s
    assert big == Decimal("100000000000000000.25")
    assert total([99999999999999.98, 99999999999999.98]) == Decimal("199999999999999.96")
    assert total([None]) is None


def test_scan_quoted_split_writes_no_file_through_one_task(spark, sf, monkeypatch):
    # Before, the whole documents table went through one task to one file.
    from plumbline.plans import q_sources
    from plumbline.sources import sinks

    parts, write = [], sinks.sink_csv
    monkeypatch.setattr(sinks, "sink_csv", lambda df, path, **kw: (
        parts.append(df.rdd.getNumPartitions()), write(df, path, **kw))[1])
    spark.conf.set("spark.sql.files.maxPartitionBytes", 64 << 10)
    try:
        docs = spark.read.parquet(f"{sf}/documents.parquet")
        got = q_sources.scan_quoted_split(spark, sf)
        assert parts == [docs.rdd.getNumPartitions()] and parts[0] > 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    assert got.select(cols).exceptAll(docs.select(cols)).count() == 0
    assert docs.select(cols).exceptAll(got.select(cols)).count() == 0
