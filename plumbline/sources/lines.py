"""Lines of text files with their numbers, and quoted records that reach over lines.

A file is read in splits by many tasks. A first pass counts lines and quotes of each split; summed up
over the splits of a file they tell each split its first line number and whether it starts inside
quotes. A second pass numbers the lines, and lines of one quoted record are put together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from plumbline.functions.sizing import broadcast_if_small

_SPLIT = ("file", "split")


def _raw(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"), F.col("value").alias("line"))


def _steps(follow, begin):
    """A function over the batches of a task, which reads its splits one after the other.

    For each run of rows of one split it calls ``follow(state, quotes, last)`` with the state that
    ``begin(batch, row)`` gives at the split's first row, and with what ``follow`` returned after
    that. All helpers are inside, so executors need no copy of this package.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = state = None
        for batch in batches:
            n = batch.num_rows
            quotes = pc.fill_null(pc.count_substring(batch.column(2), '"'), 0).to_numpy(
                zero_copy_only=False)
            file, split = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            cuts = [i for i in range(n) if i == 0 or file[i] != file[i - 1]
                    or split[i] != split[i - 1]]
            for a, b in zip(cuts, [*cuts[1:], n], strict=True):
                if (file[a], split[a]) != now:
                    now, state = (file[a], split[a]), begin(batch, a)
                state, out = follow(state, batch.slice(a, b - a), quotes[a:b].astype(np.int64))
                yield out

    return run


def _starts(raw: DataFrame) -> DataFrame:
    """Of each split: lines and records before it in its file, and whether it starts in quotes."""
    def count(odd: int, rows: pa.RecordBatch, quotes: np.ndarray) -> tuple:
        parity = (odd + np.cumsum(quotes) - quotes) % 2
        sums = (len(quotes), int(quotes.sum()) % 2, int((parity == 0).sum()))
        return (odd + sums[1]) % 2, pa.RecordBatch.from_arrays(
            [rows.column(0).slice(0, 1), rows.column(1).slice(0, 1),
             *[pa.array([x], pa.int64()) for x in sums]],
            ["file", "split", "lines", "odd", "outside"])

    splits = raw.mapInArrow(
        _steps(count, lambda rows, i: 0),
        "file string, split long, lines long, odd long, outside long").groupBy(*_SPLIT).agg(
            F.sum("lines").alias("lines"), (F.sum("odd") % 2).alias("odd"),
            F.sum("outside").alias("outside"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    sums = splits.withColumns({
        "line0": F.coalesce(F.sum("lines").over(before), F.lit(0)),
        "odd0": F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2})
    # Lines that start outside quotes start a record.
    opened = F.when(F.col("odd0") == 0, F.col("outside")).otherwise(F.col("lines") - F.col("outside"))
    return sums.withColumn("record0", F.coalesce(F.sum(opened).over(before), F.lit(0))).select(
        *_SPLIT, "line0", "odd0", "record0")


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, line_no, line, record, opens, closes) of every line, numbered from 1 in its file.

    ``record`` counts quoted records from 1; a line ``opens`` one if it starts outside quotes and
    ``closes`` one if it ends outside. Line ends are line feeds; a carriage return stays. One row for
    each split is joined to the lines, by broadcast where there are not too many.
    """
    raw = _raw(spark, path)
    joined = raw.join(broadcast_if_small(_starts(raw)), list(_SPLIT)).select(
        "file", "split", "line", "line0", "odd0", "record0")

    def number(state: tuple, rows: pa.RecordBatch, quotes: np.ndarray) -> tuple:
        line, odd, record = state
        after = odd + np.cumsum(quotes)
        opens = (after - quotes) % 2 == 0
        number, records = line + np.arange(1, len(quotes) + 1), record + np.cumsum(opens)
        return (int(number[-1]), int(after[-1]) % 2, int(records[-1])), pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(number), rows.column(2), pa.array(records.astype(np.int64)),
             pa.array(opens), pa.array(after % 2 == 0)],
            ["file", "line_no", "line", "record", "opens", "closes"])

    def begin(rows: pa.RecordBatch, i: int) -> tuple:
        return tuple(rows.column(k)[i].as_py() for k in (3, 4, 5))

    return joined.mapInArrow(
        _steps(number, begin), "file string, line_no long, line string, record long, opens boolean, "
                               "closes boolean")


def quoted_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, line_no, record, text) of every record: a line, or the lines that quotes hold together.

    Only lines of records that reach over several are shuffled. A quote that never closes makes the
    rest of its file one record, as it does for any reader. Empty lines are no records.
    """
    lines = numbered_lines(spark, path)
    whole = F.col("opens") & F.col("closes")
    one = lines.where(whole).select("file", "line_no", "record", F.col("line").alias("text"))
    many = lines.where(~whole).groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("parts")).select(
        "file", F.col("parts")[0]["line_no"].alias("line_no"), "record",
        F.array_join(F.transform("parts", lambda p: p["line"]), "\n").alias("text"))
    trimmed = F.regexp_replace("text", "\r$", "")
    return one.unionByName(many).withColumn("text", trimmed).where("text <> ''")


def scan_quoted_split(
    spark: SparkSession, path: str | list[str], schema: str | T.StructType, header: bool = True
) -> DataFrame:
    """Quoted CSV whose fields may hold separators, doubled quotes and line breaks, read by as many
    tasks as a file has splits. Rows are those of a reader that takes each file whole."""
    target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    records = quoted_records(spark, path)
    if header:
        records = records.where("record > 1")
    row = F.from_csv("text", F.lit(", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in target.fields)),
        {"quote": '"', "escape": '"', "multiLine": "true"})
    return records.select(row.alias("row")).select("row.*")
