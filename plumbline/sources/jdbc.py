"""Relational tables over JDBC: a parallel reader and a transactional writer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession


def read_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    num_partitions: int = 8,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Options for a read split into ranges of ``partition_column``.

    The bounds only place the splits: rows outside them land in the first or last split.
    """
    out = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if partition_column:
        if bounds is None:
            raise ValueError("a partition column needs its lower and upper bound")
        out.update(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(num_partitions),
        )
    return out


def scan_jdbc(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def jdbc_writer(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    batch_size: int = 5_000,
    num_partitions: int = 8,
    **extra: str,
) -> DataFrameWriter:
    """A writer with one transaction per partition and at most ``num_partitions`` connections."""
    options = {
        "url": url, "dbtable": table, "batchsize": str(batch_size),
        "numPartitions": str(num_partitions), "isolationLevel": "READ_COMMITTED", **extra,
    }
    return df.write.format("jdbc").mode(mode).options(**options)


def sink_jdbc(df: DataFrame, url: str, table: str, **options) -> None:
    jdbc_writer(df, url, table, **options).save()
