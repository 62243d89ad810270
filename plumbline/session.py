"""Session settings, table access and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def build_session(app: str = "plumbline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on.

    On a cluster leave ``master`` unset and pass a shuffle partition count sized for the
    largest exchange; adaptive execution coalesces it for the small ones and splits skewed
    join partitions.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Whole pages travel to Python: bound the batch by bytes, not only by rows.
        "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder path under the cluster's shared ``spark.checkpoint.dir``.

    Only a local session (tests, bench) may fall back to a folder of its own machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="plumbline-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/plumbline/{label}-{uuid.uuid4().hex}"


def _hadoop(spark: SparkSession, path: str):
    """The path and its file system, whatever store it is in."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, store = _hadoop(spark, path)
    return store.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote; one that is gone already is fine."""
    at, store = _hadoop(spark, path)
    store.delete(at, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def register_views(spark: SparkSession, folder: str, *names: str) -> None:
    """Temp views under the table names, for the SQL-text operators."""
    for name in names or TABLES:
        table(spark, folder, name).createOrReplaceTempView(name)
