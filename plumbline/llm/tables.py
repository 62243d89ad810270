"""Small helpers on tables that several operators share."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.session import scratch


def kept(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the cluster's shared folder and read again: its lineage ends there."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text modulo ``by``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % by


def remainders(ids, by: int) -> np.ndarray:
    """As ``remainder``, for ids that are in a task already."""
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % by for i in ids], np.int64)


def texts_of(documents: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id and text, and with ``carry`` the whole row given as the struct ``row``."""
    extra = [F.struct(*[F.col(quoted(c)) for c in documents.columns]).alias("row")] if carry else []
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.col("text").cast("string").alias("text"), *extra)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def result_schema(rows: DataFrame, ddl: str) -> StructType:
    """The fields of ``ddl`` and, if ``rows`` carries it, the struct ``row``."""
    fields = list(StructType.fromDDL(ddl).fields)
    return StructType(fields + [f for f in rows.schema.fields if f.name == "row"])


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches without rows left out."""
    return (b for b in batches if b.num_rows)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession) -> None:
    """Hand rows to Python in batches of some MB, whatever the length of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
