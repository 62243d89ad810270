"""Reconciliation runs whose options are kept in a config table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.plans.config import CONFIG_SCHEMA, config_load, config_save, spec_rows
from plumbline.plans.report import ReconResult, reconcile
from plumbline.session import scratch
from plumbline.sources.sinks import sink_replace_slice
from plumbline.spec import ReconSpec


def config_table(spark: SparkSession, path: str) -> DataFrame:
    """The config table at ``path``, partitioned by user; made empty if there is none."""
    spark.createDataFrame([], CONFIG_SCHEMA).write.mode("ignore").partitionBy("user_id").parquet(path)
    # A folder without files has no schema of its own.
    return spark.read.schema(CONFIG_SCHEMA).parquet(path).select(
        "left_tbl", "right_tbl", "arg_name", "arg_dt", "arg_val", "user_id")


def reconcile_saved(
    spark: SparkSession, path: str, names: tuple[str, str], left: DataFrame, right: DataFrame,
    user: str, passed: Mapping[str, object],
) -> ReconResult:
    """Load the options saved for (left name, user), run with the passed ones on top, save all.

    Only the user's slice of the table is written again. It goes to the shared folder first, since
    files that are being read cannot be replaced.
    """
    saved = config_table(spark, path)
    spec = ReconSpec(**config_load(saved, names[0], user, passed))
    result = reconcile(left, right, spec, spark)
    own = saved.filter(F.lower(F.trim("user_id")) == user.strip().lower())
    rows = config_save(own, spec_rows(spark, *names, spec, user))
    staged = scratch(spark, "config")
    rows.withColumn("user_id", F.lit(user)).write.parquet(staged)
    sink_replace_slice(spark.read.schema(rows.schema).parquet(staged), path, "user_id")
    return result
