"""Structured Streaming readers, decoders and sinks. Checkpoints live in a shared folder."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.canonical import quoted, row_mark
from plumbline.session import exists
from plumbline.sources.sinks import sink_batch


def file_stream(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    fmt: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """Newly landed files, each read once."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def kafka_options(
    brokers: Sequence[str], topic: str, starting: str = "earliest",
    max_offsets: int | None = None, min_partitions: int | None = None, **extra: str,
) -> dict[str, str]:
    """Reader options for subscribing to a topic."""
    out = {
        "kafka.bootstrap.servers": ",".join(brokers), "subscribe": topic,
        "startingOffsets": starting, "failOnDataLoss": "true", **extra,
    }
    if max_offsets:
        out["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions:
        out["minPartitions"] = str(min_partitions)
    return out


def kafka_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Subscribe to a topic (needs Spark's Kafka connector package)."""
    return spark.readStream.format("kafka").options(**options).load()


def decode_json(
    stream: DataFrame, value: str, schema: str, malformed: str | None = None
) -> DataFrame:
    """Message bytes or text to columns by a JSON schema; batch and stream alike.

    With ``malformed`` a column of that name holds the text of each message that is no JSON
    object, or null; without it such a message gives a row of nulls.
    """
    if malformed is None:
        message = F.from_json(F.col(value).cast("string"), schema)
        return stream.select(message.alias("_m")).select("_m.*")
    text = F.col(value).cast("string")
    message = F.from_json(text, f"{schema}, {quoted(malformed)} string",
                          {"columnNameOfCorruptRecord": malformed})
    broken = F.coalesce(F.col(f"_m.{quoted(malformed)}"),
                        F.when(F.col("_m").isNull() | ~F.coalesce(
                            F.ltrim(F.col("_t"), F.lit(" \t\n\r")).startswith("{"), F.lit(False)),
                            F.coalesce(F.col("_t"), F.lit(""))))
    rows = stream.select(message.alias("_m"), text.alias("_t"))
    return rows.select(F.col("_m").dropFields(malformed).alias("_m"), broken.alias(malformed)
                       ).select("_m.*", quoted(malformed))


def typed_or_bad(
    df: DataFrame, types: Mapping[str, str], malformed: str | None = None
) -> DataFrame:
    """All-text columns to typed ones plus ``bad_columns``: the names that did not convert.

    A row whose ``malformed`` text is set has that name as its bad column and keeps the text.
    """
    bad = F.filter(
        F.array(*[
            F.when(F.col(quoted(c)).isNotNull() & F.col(quoted(c)).try_cast(t).isNull(), F.lit(c))
            for c, t in types.items()
        ]),
        lambda x: x.isNotNull(),
    )
    typed = [F.col(quoted(c)).try_cast(t).alias(c) for c, t in types.items()]
    names = F.array_join(bad, ",")
    if malformed is None:
        return df.select(*typed, names.alias("bad_columns"))
    names = F.when(F.col(quoted(malformed)).isNotNull(), F.lit(malformed)).otherwise(names)
    return df.select(*typed, names.alias("bad_columns"), quoted(malformed))


def run_available(
    stream: DataFrame, path: str, checkpoint: str, part: Sequence[str] = (), fmt: str = "parquet"
) -> None:
    """Land everything available now as files, exactly once per checkpoint, then stop."""
    writer = stream.writeStream.format(fmt).option("checkpointLocation", checkpoint)
    if part:
        writer = writer.partitionBy(*part)
    query = writer.trigger(availableNow=True).start(path)
    query.awaitTermination()


def with_lake_parts(stream: DataFrame, ts: str) -> DataFrame:
    return stream.withColumns({"dt": F.to_date(ts), "hour": F.hour(ts)})


def land_lake(
    stream: DataFrame, path: str, checkpoint: str, ts: str, parts: Sequence[str] = ("dt", "hour")
) -> None:
    """Land everything available now under ``dt=/hour=/batch=``, then stop.

    Each batch is dealt by range to tasks before it is written, so that an hour has few files, and
    an hour too large for one task is split. A batch repeated after a failure replaces itself.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rest = [c for c in ("dt", "hour") if c not in parts]
        sink_batch(with_lake_parts(batch, ts).drop(*rest), path, parts, [ts], batch_id)

    stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(
        availableNow=True).start().awaitTermination()


def clickstream_counts(
    stream: DataFrame, ts: str, by: str, window: str = "1 day", delay: str = "1 hour"
) -> DataFrame:
    """Rows per tumbling event-time window and type; rows behind the watermark are dropped.

    A watermark needs a zoned timestamp, so a plain one is cast first.
    """
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return timed.groupBy(F.window(ts, window), by).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("window.start").alias("window_start"), by, "n"
    )


def append_updates(counts: DataFrame, path: str, checkpoint: str) -> None:
    """Write each batch's changed groups with the batch number; a repeated batch replaces itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(
        write
    ).trigger(availableNow=True).start().awaitTermination()


def latest_update(spark: SparkSession, path: str, keys: Sequence[str], value: str) -> DataFrame:
    """The last written value per group."""
    return spark.read.parquet(path).groupBy(*keys).agg(F.max_by(value, "batch").alias(value))


# --- late rows ------------------------------------------------------------------------


def windows_with_late(
    stream: DataFrame, out: str, checkpoint: str, ts: str, by: str, window: str = "1 day",
    delay: str = "1 hour",
) -> None:
    """Rows per tumbling event-time window and type, and every late row set aside.

    A row is late if its window had ended at the watermark: the latest time of all earlier batches
    less ``delay``, the rule by which Spark's own windowed counts drop rows. Each batch is bounded by
    the reader's option and leaves folders under its number: ``late`` (the rows as they came, and
    rows without a time), ``closed`` (windows that can no longer change), ``open`` (the others, all
    that the next batch needs), and ``mark``, written last. A batch repeated after a failure
    replaces its folders and starts from the same earlier ones, so counted and late rows together
    are the input.
    """
    spark = stream.sparkSession

    def earlier(name: str, schema: str, batch_id: int) -> DataFrame:
        if not exists(spark, f"{out}/{name}"):
            return spark.createDataFrame([], f"{schema}, batch long")
        return spark.read.schema(f"{schema}, batch long").parquet(f"{out}/{name}").where(
            F.col("batch") < batch_id)

    def write(batch: DataFrame, batch_id: int) -> None:
        def put(df: DataFrame, name: str) -> None:
            df.write.mode("overwrite").parquet(f"{out}/{name}/batch={batch_id}")

        seen = Observation()
        before = earlier("mark", "latest timestamp", batch_id).agg(
            F.max("latest").alias("latest"), F.max("batch").alias("batch")).first()
        # In microseconds: a window expression would drop rows without a time.
        micros = lambda interval: F.expr(
            f"unix_micros(timestamp_micros(0) + INTERVAL {interval})")
        at = F.unix_micros(F.col(quoted(ts)).cast("timestamp"))
        start = at - F.pmod(at, micros(window))
        mark = lambda t: F.unix_micros(F.lit(t).cast("timestamp")) - micros(delay)
        late = F.coalesce(start + micros(window) <= mark(before.latest), at.isNull())
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)  # one bounded batch
        try:
            put(kept.observe(seen, F.max(F.col(quoted(ts)).cast("timestamp")).alias("latest")).where(
                late), "late")
            latest = max((t for t in (before.latest, seen.get["latest"]) if t), default=None)
            counts = kept.where(~late).groupBy(
                F.timestamp_micros(start).alias("window_start"), F.col(quoted(by)).alias("type")
            ).agg(F.count(F.lit(1)).alias("n"))
            last = -1 if before.batch is None else before.batch
            kind = f"window_start timestamp, type {batch.schema[by].dataType.simpleString()}, n long"
            still = earlier("open", kind, batch_id).where(F.col("batch") == last).drop("batch")
            now = counts.unionByName(still).groupBy("window_start", "type").agg(F.sum("n").alias("n"))
            closes = F.unix_micros("window_start") + micros(window) <= mark(latest)
            put(now.where(F.coalesce(closes, F.lit(False))), "closed")
            put(now.where(~F.coalesce(closes, F.lit(False))), "open")
            put(spark.createDataFrame([(latest,)], "latest timestamp"), "mark")
        finally:
            kept.unpersist()

    stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(
        availableNow=True).start().awaitTermination()


def counted_windows(spark: SparkSession, out: str, kind: str = "string") -> DataFrame:
    """(window_start, type, n) of closed and open windows, as of the last whole batch."""
    schema = f"window_start timestamp, type {kind}, n long, batch long"
    last = spark.read.parquet(f"{out}/mark").agg(F.max("batch")).first()[0]
    closed, still = (spark.read.schema(schema).parquet(f"{out}/{name}") for name in (
        "closed", "open"))
    return closed.where(F.col("batch") <= last).unionByName(
        still.where(F.col("batch") == last)).drop("batch")


# --- change data ----------------------------------------------------------------------


def newest_changes(changes: DataFrame, key: str, seq: str) -> DataFrame:
    """The change with the highest sequence number per key; a partial aggregate.

    Of equal numbers the row with the greatest mark counts, whatever order they arrive in.
    """
    rest = [c for c in changes.columns if c != key]
    newest = F.struct(F.col(quoted(seq)).alias("seq"), row_mark(changes).alias("mark"))
    top = changes.groupBy(F.col(quoted(key))).agg(
        F.max_by(F.struct(*[F.col(quoted(c)) for c in rest]), newest).alias("_c"))
    return top.select(quoted(key), *[F.col(f"_c.{quoted(c)}").alias(c) for c in rest])


def land_changes(changes: DataFrame, path: str, checkpoint: str, key: str, seq: str) -> None:
    """Write each batch's newest change per key under its batch number.

    Only changed rows are written, never the table; a batch repeated after a failure replaces
    itself.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        newest_changes(batch, key, seq).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(
        availableNow=True
    ).start().awaitTermination()


def fold_changes(
    spark: SparkSession, base: str, log: str, target: str, key: str, seq: str, op: str
) -> list[int]:
    """Write the next base, with all landed batches folded in, to a new folder.

    Returns the numbers of the batches that it holds, so that the caller can retire exactly
    these after switching to the new base. A rerun writes the same rows.
    """
    rows, landed = spark.read.parquet(base), spark.read.parquet(log)
    batches = sorted(r.batch for r in landed.select("batch").distinct().collect())
    taken = landed.filter(F.col("batch").isin(batches)).drop("batch")
    apply_changes(rows, taken, key, seq, op).write.mode("overwrite").parquet(target)
    return batches


def apply_changes(
    base: DataFrame, changes: DataFrame, key: str, seq: str, op: str
) -> DataFrame:
    """The live rows of a table after all changes, without op and sequence number.

    Each key takes its change with the highest sequence number, so a stale change loses
    whenever it arrives; untouched rows come through an anti join. ``changelog`` keeps such a table
    with the landed changes folded in.
    """
    newest = newest_changes(changes, key, seq)
    live = newest.filter(F.col(op) != "D").select(*base.columns)
    kept = base.join(newest.select(key), key, "left_anti").select(*base.columns)
    return kept.unionByName(live)
