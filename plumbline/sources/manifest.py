"""A Parquet table whose live files are named by numbered versions.

``root/files`` holds the data files, and ``root/versions/v=N`` one small Parquet file that lists those of
version N with the least and greatest key of each. A change writes new files and then the next version:
readers see either all of it or nothing, and of two writers of one version the second fails. Only the
files that a change touches are read and written again; the others go on under their names.
"""

from __future__ import annotations

import datetime
import decimal
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from plumbline.functions.canonical import free_name, quoted
from plumbline.operators.relational import dup_groups, range_spread, without
from plumbline.session import exists, remove

#: Ranges of key values that a change is narrowed by.
RANGES = 64
_ORDERED = (int, str, decimal.Decimal, datetime.date, datetime.datetime)


@dataclass(frozen=True)
class Version:
    """One state of the table. ``files`` are rows (file, rows, lo, hi); lo and hi hold the keys."""

    number: int
    files: tuple[Row, ...]
    keys: tuple[str, ...]
    schema: T.StructType
    note: dict

    @property
    def names(self) -> set[str]:
        return {f.file for f in self.files}


def _key_schema(schema: T.StructType, keys: Sequence[str]) -> T.StructType:
    """Keys by position, so that any column name will do."""
    return T.StructType([T.StructField(f"k{i}", schema[k].dataType) for i, k in enumerate(keys)])


def _file_schema(schema: T.StructType, keys: Sequence[str]) -> T.StructType:
    key = _key_schema(schema, keys)
    return T.StructType().add("file", "string").add("rows", "long").add("lo", key).add("hi", key).add(
        "about", "string")


def current(spark: SparkSession, root: str) -> Version | None:
    """The newest version; the driver gets one row for each live file."""
    if not exists(spark, f"{root}/versions"):
        return None
    versions = spark.read.parquet(f"{root}/versions")
    last = versions.agg(F.max("v")).first()[0]
    rows = versions.where(F.col("v") == last).drop("v").collect()
    about = json.loads(next(r.about for r in rows if r.about is not None))
    return Version(last, tuple(r for r in rows if r.file is not None), tuple(about["keys"]),
                   T.StructType.fromJson(about["schema"]), about["note"])


def _publish(spark: SparkSession, root: str, version: Version) -> Version:
    about = json.dumps({"keys": version.keys, "schema": version.schema.jsonValue(),
                        "note": version.note})
    rows = [(f.file, f.rows, f.lo, f.hi, None) for f in version.files]
    listed = spark.createDataFrame([*rows, (None, None, None, None, about)],
                                   _file_schema(version.schema, version.keys))
    # A single file, which appears under its name when it is whole.
    listed.coalesce(1).write.mode("error").parquet(f"{root}/versions/v={version.number}")
    return version


def _written(spark: SparkSession, root: str, rows: DataFrame, keys: Sequence[str],
             part: str | None = None) -> list[Row]:
    """Write rows as new files; (file, rows, lo, hi) of those that hold any.

    Rows are dealt and sorted by the keys, so that a file covers a narrow range of them.
    """
    folder = f"{root}/files/{uuid.uuid4().hex}"
    by = [part, *keys] if part else list(keys)
    laid = range_spread(rows, *by).sortWithinPartitions(*[F.col(quoted(c)) for c in by])
    writer = laid.write.partitionBy(part) if part else laid.write
    writer.parquet(folder)
    schema = T.StructType([f for f in rows.schema.fields if f.name != part])
    key = F.struct(*[F.col(quoted(k)).alias(f"k{i}") for i, k in enumerate(keys)])
    found = spark.read.schema(schema).parquet(folder)
    return found.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(key).alias("lo"), F.max(key).alias("hi")).collect()


def create(spark: SparkSession, root: str, rows: DataFrame, keys: Sequence[str],
           note: dict | None = None) -> Version:
    """Version 0 of a new table, clustered by ``keys``."""
    files = _written(spark, root, rows, keys)
    return _publish(spark, root, Version(0, tuple(files), tuple(keys), rows.schema, note or {}))


def read(spark: SparkSession, version: Version, files: Sequence[str] | None = None) -> DataFrame:
    """The rows of a version, or of some of its files."""
    names = sorted(version.names if files is None else files)
    if not names:
        return spark.createDataFrame([], version.schema)
    return spark.read.schema(version.schema).parquet(*names)


def append(spark: SparkSession, root: str, rows: DataFrame, note: dict | None = None) -> Version:
    """The next version, with more files."""
    old = current(spark, root)
    rows = rows.select(*[F.col(quoted(c)) for c in old.schema.names])
    files = (*old.files, *_written(spark, root, rows, old.keys))
    return _publish(spark, root, Version(old.number + 1, files, old.keys, old.schema,
                                         old.note if note is None else note))


def _narrowed(version: Version, source: DataFrame) -> list[str]:
    """Files whose range of the first key meets a range of the source's values.

    The source is dealt to ``RANGES`` ranges, of which the driver gets the ends. Values that Python
    does not order as Spark does leave all files in.
    """
    first = version.keys[0]
    if first not in source.columns:
        return sorted(version.names)
    values = source.select(F.col(quoted(first)).alias("v")).where("v IS NOT NULL")
    ranges = values.repartitionByRange(RANGES, "v").groupBy(F.spark_partition_id()).agg(
        F.min("v").alias("lo"), F.max("v").alias("hi")).select("lo", "hi").collect()
    ends = [x for r in ranges for x in r] + [x[0] for f in version.files for x in (f.lo, f.hi)]
    if any(x is not None and not isinstance(x, _ORDERED) for x in ends):
        return sorted(version.names)
    return sorted(f.file for f in version.files if f.hi[0] is not None and any(
        (f.lo[0] is None or f.lo[0] <= r.hi) and r.lo <= f.hi[0] for r in ranges))


def touched(spark: SparkSession, version: Version, source: DataFrame, keys: Sequence[str]
            ) -> list[str]:
    """Files that hold a row with a key of the source: narrowed by the listed ranges, then found by
    reading the key columns of what is left."""
    narrow = _narrowed(version, source)
    if not narrow:
        return []
    at = free_name("file", source)
    rows = read(spark, version, narrow).select(
        *[F.col(quoted(k)) for k in keys], F.col("_metadata.file_path").alias(at)).alias("t")
    own = source.select(*[F.col(quoted(k)) for k in keys]).alias("s")
    cond = [F.col(f"t.{quoted(k)}") == F.col(f"s.{quoted(k)}") for k in keys]
    return sorted(r[0] for r in rows.join(own, cond, "left_semi").select(at).distinct().collect())


def rewrite(spark: SparkSession, root: str, source: DataFrame, keys: Sequence[str],
            change: Callable[[DataFrame], DataFrame], note: dict | None = None) -> Version:
    """The next version: the files that hold a key of ``source`` are replaced by
    ``change(their rows)``, the others stay."""
    old = current(spark, root)
    gone = touched(spark, old, source, keys)
    rows = change(read(spark, old, gone)).select(*[F.col(quoted(c)) for c in old.schema.names])
    files = tuple(f for f in old.files if f.file not in set(gone))
    return _publish(spark, root, Version(
        old.number + 1, (*files, *_written(spark, root, rows, old.keys)), old.keys, old.schema,
        old.note if note is None else note))


def upsert_files(spark: SparkSession, root: str, source: DataFrame, keys: Sequence[str]) -> Version:
    """Put rows into the table: matched keys replaced, other rows added.

    Two source rows for one key are an error, as they are for MERGE; a null key matches nothing.
    """
    if not dup_groups(source.dropna(subset=[quoted(k) for k in keys]), keys).isEmpty():
        raise ValueError(f"source holds several rows for one key {list(keys)}")

    def change(rows: DataFrame) -> DataFrame:
        cols = [F.col(quoted(c)) for c in rows.columns]
        return without(rows, source, keys).select(*cols).unionByName(source.select(*cols))

    return rewrite(spark, root, source, keys, change)


def delete_files(spark: SparkSession, root: str, source: DataFrame, keys: Sequence[str]) -> Version:
    """Remove the rows whose key a source row has."""
    return rewrite(spark, root, source, keys,
                   lambda rows: without(rows, source, keys).select(*[
                       F.col(quoted(c)) for c in rows.columns]))


# --- order ------------------------------------------------------------------------------


def _listed(spark: SparkSession, version: Version) -> DataFrame:
    return spark.createDataFrame([(f.file, f.rows, f.lo, f.hi, None) for f in version.files],
                                 _file_schema(version.schema, version.keys))


def overlap_depth(spark: SparkSession, version: Version) -> int:
    """The largest number of files of which a reader of one key range needs all; 1 is sorted.

    Files that only share an end value do not overlap. The list of files goes through one task.
    """
    files = _listed(spark, version)
    ends = files.select(F.col("lo").alias("at"), F.lit(1).alias("step")).unionByName(
        files.select(F.col("hi").alias("at"), F.lit(-1).alias("step")))
    open_ = F.sum("step").over(Window.orderBy("at", "step").rowsBetween(
        Window.unboundedPreceding, 0))
    depth = ends.select(open_.alias("n")).agg(F.max("n")).first()[0] or 0
    return max(depth, 1) if version.files else 0


def unsorted_files(spark: SparkSession, version: Version) -> DataFrame:
    """(file, part) of the files whose key ranges overlap another's; files that hang together by
    overlaps have one part. The list of files goes through one task, the files do not."""
    order = Window.orderBy("lo", "hi", "file")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    files = _listed(spark, version).select("file", "lo", "hi", F.max("hi").over(before).alias("past"))
    starts = files.withColumn("part", F.sum(F.when(F.col("lo") < F.col("past"), 0).otherwise(1)).over(
        order.rowsBetween(Window.unboundedPreceding, 0)))
    many = starts.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("part")))
    return many.where("n > 1").select("file", "part")


def recluster(spark: SparkSession, root: str) -> Version:
    """The next version, in which the unsorted files are sorted; files in order are not read.

    Each group of overlapping files is written for itself, so that no new file reaches across one
    that stays. A table in order stays as it is.
    """
    old = current(spark, root)
    dirty = unsorted_files(spark, old).collect()  # at most a row for each file
    if not dirty:
        return old
    part, at = "part", "file"
    while part in old.schema.names:
        part += "_"
    while at in old.schema.names or at == part:
        at += "_"
    groups = spark.createDataFrame([tuple(r) for r in dirty], f"`{at}` string, `{part}` long")
    gone = {r.file for r in dirty}
    rows = read(spark, old, sorted(gone)).select(
        "*", F.col("_metadata.file_path").alias(at)).join(groups, at).drop(at)
    files = tuple(f for f in old.files if f.file not in gone)
    return _publish(spark, root, Version(
        old.number + 1, (*files, *_written(spark, root, rows, old.keys, part)), old.keys,
        old.schema, old.note))


def table_info(spark: SparkSession, root: str) -> DataFrame:
    """One row: files, bytes and rows that the table's folder holds, and the rows and files of them
    that its current version shows."""
    version = current(spark, root)
    stored = spark.read.schema(version.schema).option("recursiveFileLookup", True).parquet(
        f"{root}/files")
    each = stored.groupBy("_metadata.file_path").agg(
        F.count(F.lit(1)).alias("rows"), F.max("_metadata.file_size").alias("bytes"))
    return each.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).withColumns({
            "visible_files": F.lit(len(version.files)).cast("long"),
            "visible_rows": F.lit(sum(f.rows for f in version.files)).cast("long")})


def retire(spark: SparkSession, root: str, keep: int = 1) -> None:
    """Delete the versions before the last ``keep``, and the files that only they name.

    Not for a table that a job with an older version still reads. A folder goes when no kept version
    has a file in it, so files of a folder in use stay until all of them are replaced.
    """
    numbers = sorted(r.v for r in spark.read.parquet(f"{root}/versions").select("v").distinct()
                     .collect())
    old, kept = numbers[:-keep], numbers[-keep:]
    if not old:
        return
    listed = spark.read.parquet(f"{root}/versions").where("file IS NOT NULL")
    folder: Column = F.regexp_extract("file", r"/files/([0-9a-f]{32})/", 1)
    named = listed.groupBy(folder.alias("folder")).agg(
        F.max(F.col("v").isin(kept)).alias("live")).where("NOT live").collect()
    for number in old:
        remove(spark, f"{root}/versions/v={number}")
    for r in named:
        remove(spark, f"{root}/files/{r.folder}")
