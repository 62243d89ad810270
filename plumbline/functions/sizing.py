"""Deciding by measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.canonical import row_text

# A broadcast side is held whole by every executor: stay well below its memory.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def _row_bound(df: DataFrame) -> int | None:
    """Most bytes a row can take, or None with a column of open length."""
    fixed = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
    if all(isinstance(f.dataType, fixed) for f in df.schema.fields):
        return 16 * len(df.schema.fields)
    return None


def broadcast_if_small(
    df: DataFrame,
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
    known_rows: int | None = None,
) -> DataFrame:
    """Mark for broadcast only when the side is proven small.

    The proof is a row count the caller has and a bounded row width, or else a look at no
    more than ``max_rows + 1`` rows. Beyond either bound the frame comes back unmarked, and
    Spark picks a shuffled join.
    """
    width = _row_bound(df)
    if known_rows is not None and width is not None:
        small = known_rows <= max_rows and known_rows * width <= max_bytes
        return F.broadcast(df) if small else df
    seen = df.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(row_text(df))).alias("b")
    ).first()
    small = seen.n <= max_rows and (seen.b or 0) <= max_bytes
    return F.broadcast(df) if small else df


def task_count(spark: SparkSession) -> int:
    """The number of shuffle partitions the session is set up for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
