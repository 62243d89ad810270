"""Table and file writers. None of them overwrites a path it reads from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.relational import range_spread, upsert
from plumbline.session import scratch
from plumbline.sources.readers import unique_name


def _table_writer(df: DataFrame, mode: str, path: str | None):
    writer = df.write.mode(mode).format("parquet")
    return writer.option("path", path) if path else writer


def sink_overwrite(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a table's rows and schema."""
    _table_writer(df, "overwrite", path).option("overwriteSchema", True).saveAsTable(name)


def sink_append(df: DataFrame, name: str, path: str | None = None) -> None:
    _table_writer(df, "append", path).saveAsTable(name)


def sink_partitioned(
    df: DataFrame, name: str, part: str, order: Sequence[str], path: str | None = None
) -> None:
    """Replace a table, partitioned by a column and sorted inside each file.

    A range exchange on the partition and sort columns spreads a large partition value over
    several tasks and files instead of sending it to one.
    """
    rest = [c for c in order if c != part]
    laid = range_spread(df, part, *rest).sortWithinPartitions(part, *rest)
    _table_writer(laid, "overwrite", path).partitionBy(part).saveAsTable(name)


def sink_replace_slice(df: DataFrame, path: str, part: str) -> None:
    """Replace only the partitions that the rows name; the others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        part
    ).parquet(path)


def sink_csv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").csv(
        path, header=header, quote='"', escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def with_hive_parts(df: DataFrame, ts: str) -> DataFrame:
    """Add year, month, day and hour of a time column."""
    return df.select(
        "*",
        F.year(ts).alias("year"), F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"), F.hour(ts).alias("hour"),
    )


def sink_batch(
    df: DataFrame, path: str, parts: Sequence[str], order: Sequence[str], batch: int | str
) -> None:
    """One batch as files under ``<part>=.../batch=<batch>``.

    A range exchange groups the rows of a folder so that it has few files; a folder, or one value of
    the order, too large for one task is split. Only folders of the same batch are replaced: a
    repeated batch leaves what it left before, and a later batch of the same hour is added.
    """
    if "batch" in {c.lower() for c in df.columns}:
        raise ValueError("the frame has a column batch")
    laid = range_spread(df, *parts, *order).withColumn("batch", F.lit(batch))
    laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *parts, "batch").parquet(path)


def sink_hive_layout(df: DataFrame, path: str, ts: str, batch: int | str = 0) -> None:
    """Files under ``year=/month=/day=/hour=/batch=``, as by :func:`sink_batch`."""
    sink_batch(with_hive_parts(df, ts), path, ["year", "month", "day", "hour"], [ts], batch)


def sink_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def sink_swap_table(spark: SparkSession, old: str, new: str) -> None:
    """Drop the old table and give the new one its name."""
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {old}")


def sink_upsert(
    spark: SparkSession, name: str, source: DataFrame, keys: Sequence[str], path: str
) -> None:
    """Put rows into a table of a format without MERGE: write the merged table, then swap.

    Two source rows for one key are an error, as they are for MERGE.
    """
    merged = upsert(spark.table(name), source, keys, check=True)
    new = unique_name(f"{name}_new")
    sink_overwrite(merged, new, path)
    sink_swap_table(spark, name, new)


def sink_upsert_slices(
    spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], part: str
) -> None:
    """Put rows into a Parquet folder partitioned by ``part``; only the slices they name are read
    and written again.

    ``part`` must be one of the keys, so that a row cannot move to another slice. The new slices go
    to the shared folder first, since files that are being read cannot be replaced.
    """
    if part not in keys:
        raise ValueError(f"the keys must hold the partition column {part}")
    target = spark.read.parquet(path)
    touched = source.select(part).distinct()
    own = target.join(touched, part, "left_semi").select(*target.columns)
    staged = scratch(spark, "upsert")
    upsert(own, source, keys, check=True).write.parquet(staged)
    sink_replace_slice(spark.read.schema(target.schema).parquet(staged), path, part)


def merge_into(df: DataFrame, table: str, on: Column) -> None:
    """MERGE rows into a table of a transactional format (the format's jar must be present)."""
    df.mergeInto(table, on).whenMatched().updateAll().whenNotMatched().insertAll().merge()
