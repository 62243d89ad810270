"""Streams over files that Spark landed; each runs until nothing new is left."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.plans.catalog import query
from plumbline.plans.derived import SALES_COLUMNS, SALES_SQL, SALES_TYPES, pair, sales, with_pair
from plumbline.session import scratch, table
from plumbline.streaming import changelog, streams


# Landed files per batch: bounds the size of a batch, not what is read in all.
MAX_FILES = 1000


def _land(df, spark, label, fmt="parquet"):
    """Rows written once as files; text is gzipped, so the landing weighs what Parquet would."""
    path = scratch(spark, label)
    writer = df.write.format(fmt)
    if fmt in ("text", "json"):
        writer = writer.option("compression", "gzip")
    writer.save(path)
    return path


def _typed_sales(spark, sf):
    """Every sale as a JSON message, and with every seventh order a message cut short."""
    rows = sales(spark, sf).select(F.to_json(F.struct("*")).alias("value"))
    cut = table(spark, sf, "orders").where("o_orderkey % 7 = 0").select(
        F.concat(F.lit('{"uuid": "'), F.col("o_orderkey").cast("string")).alias("value"))
    path = _land(rows.unionByName(cut), spark, "sales-topic", "text")
    raw = streams.file_stream(spark, path, "value string", "text", MAX_FILES)
    text = ", ".join(f"{c} string" for c in SALES_COLUMNS)
    typed = streams.typed_or_bad(streams.decode_json(raw, "value", text, "malformed"),
                                 SALES_TYPES, "malformed")
    out = scratch(spark, "sales-typed")
    streams.run_available(typed, out, scratch(spark, "sales-typed-checkpoint"))
    return spark.read.parquet(out)


@query("stream_json_typed", f"""
    WITH {SALES_SQL}
    SELECT uuid, CAST(orderdate AS DATE) AS orderdate, CAST(unitssold AS INTEGER) AS unitssold,
           CAST(totalrevenue AS DECIMAL(12,2)) AS totalrevenue FROM sales WHERE unitssold <> 'n/a'""")
def stream_json_typed(spark, sf):
    return _typed_sales(spark, sf).filter("bad_columns = ''").select(
        "uuid", "orderdate", "unitssold", "totalrevenue")


@query("stream_json_bad_rows", f"""
    WITH {SALES_SQL}
    SELECT uuid, 'unitssold' AS bad_columns, NULL::VARCHAR AS message FROM sales
      WHERE unitssold = 'n/a'
    UNION ALL SELECT NULL, 'malformed', '{{"uuid": "' || o_orderkey FROM orders
      WHERE o_orderkey % 7 = 0""")
def stream_json_bad_rows(spark, sf):
    return _typed_sales(spark, sf).filter("bad_columns <> ''").select(
        F.when(F.col("malformed").isNull(), F.col("uuid")).alias("uuid"), "bad_columns",
        F.col("malformed").alias("message"))


@query("stream_new_files", "SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_new_files(spark, sf):
    """Two landings and three runs with one checkpoint: every file is read once."""
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    path = scratch(spark, "landing")
    out, mark = scratch(spark, "landed"), scratch(spark, "landed-checkpoint")
    clicks = F.col("event_type") == "click"
    for part in (clicks, ~clicks, None):
        if part is not None:
            events.filter(part).write.mode("append").parquet(path)
        stream = streams.file_stream(spark, path, events.schema, max_files=MAX_FILES)
        streams.run_available(stream, out, mark)
    return spark.read.parquet(out)


@query("stream_kafka_reader", "SELECT event_id, event_type, value FROM events")
def stream_kafka_reader(spark, sf):
    """The decode step of a topic reader, fed by files that hold key and value bytes."""
    events = table(spark, sf, "events")
    body = F.to_json(F.struct("event_id", "event_type", "value")).cast("binary")
    path = _land(events.select(F.col("event_id").cast("string").cast("binary").alias("key"),
                               body.alias("value")), spark, "topic")
    raw = streams.file_stream(spark, path, "key binary, value binary")
    rows = streams.decode_json(raw, "value", "event_id bigint, event_type string, value double")
    out = scratch(spark, "topic-rows")
    streams.run_available(rows, out, scratch(spark, "topic-checkpoint"))
    return spark.read.parquet(out)


@query("stream_cdc_apply", with_pair("""
    SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM pair"""))
def stream_cdc_apply(spark, sf):
    """Orders turned into their changed version by insert, update and delete rows.

    Every update also has a stale forerunner with a lower number, which must lose.
    """
    left, right = pair(spark, sf)
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    base, new = left.select(*cols), right.select(*cols).distinct()
    upserts = new.join(base.select("o_orderkey", F.lit(1).alias("known")), "o_orderkey", "left").select(
        F.when(F.col("known").isNull(), "I").otherwise("U").alias("op"),
        F.lit(10).cast("long").alias("seq"), *cols)
    deletes = base.join(new, "o_orderkey", "left_anti").select(
        F.lit("D").alias("op"), F.lit(10).cast("long").alias("seq"), *cols)
    stale = base.select(F.lit("U").alias("op"), F.lit(5).cast("long").alias("seq"), "o_orderkey",
                        "o_custkey", F.lit("stale").alias("o_orderstatus"), "o_totalprice")
    changes = upserts.unionByName(deletes).unionByName(stale)
    path = _land(changes, spark, "changes")
    landed = scratch(spark, "changes-landed")
    stream = streams.file_stream(spark, path, changes.schema, max_files=MAX_FILES)
    streams.land_changes(stream, landed, scratch(spark, "changes-checkpoint"), "o_orderkey", "seq")
    return streams.apply_changes(base, spark.read.parquet(landed), "o_orderkey", "seq", "op")


@query("stream_to_lake", """
    SELECT event_id, event_type, CAST(ts AS DATE) AS dt, CAST(hour(ts) AS INTEGER) AS hour
    FROM events""")
def stream_to_lake(spark, sf):
    events = table(spark, sf, "events")
    path = _land(events, spark, "lake-in")
    stream = streams.file_stream(spark, path, events.schema, max_files=MAX_FILES)
    out = scratch(spark, "lake")
    streams.land_lake(stream, out, scratch(spark, "lake-checkpoint"), "ts")
    return spark.read.parquet(out).select("event_id", "event_type", "dt", "hour")


@query("stream_clickstream", """
    SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n FROM events
    GROUP BY ALL""")
def stream_clickstream(spark, sf):
    events = table(spark, sf, "events")
    path = _land(events.select("ts", "event_type"), spark, "clicks")
    stream = streams.file_stream(spark, path, "ts timestamp_ntz, event_type string")
    out = scratch(spark, "click-counts")
    counts = streams.clickstream_counts(stream, "ts", "event_type")
    streams.append_updates(counts, out, scratch(spark, "click-checkpoint"))
    rows = streams.latest_update(spark, out, ["window_start", "event_type"], "n")
    return rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def _changes(spark, sf):
    """(base, changes) that turn orders into its changed version, with stale forerunners."""
    left, right = pair(spark, sf)
    cols, key = left.columns, "o_orderkey"
    new = right.distinct()
    known = left.select(key, F.lit(1).alias("known"))
    upserts = new.join(known, key, "left").select(
        F.when(F.col("known").isNull(), "I").otherwise("U").alias("op"),
        F.lit(10).cast("long").alias("seq"), *cols)
    deletes = left.join(new, key, "left_anti").select(
        F.lit("D").alias("op"), F.lit(10).cast("long").alias("seq"), *cols)
    stale = left.withColumn("o_orderstatus", F.lit("stale")).select(
        F.lit("U").alias("op"), F.lit(5).cast("long").alias("seq"), *cols)
    return left, upserts.unionByName(deletes), stale


@query("stream_cdc_fold", with_pair("""
    , now AS (SELECT DISTINCT * FROM pair)
    SELECT 'landed' AS state, * FROM now WHERE o_orderkey % 2 = 0
    UNION ALL SELECT 'landed', * FROM orders WHERE o_orderkey % 2 <> 0
    UNION ALL SELECT 'folded', * FROM now WHERE o_orderkey % 2 = 0
    UNION ALL SELECT 'folded', * FROM orders WHERE o_orderkey % 2 <> 0
    UNION ALL SELECT 'landed again', * FROM now
    UNION ALL SELECT 'folded again', * FROM now
    UNION ALL SELECT 'folded once more', * FROM now"""))
def stream_cdc_fold(spark, sf):
    """Two landings in several batches, each folded into the base; the table after every step.

    Stale changes land before and, for the first half, after the newer change was folded. The
    second landing is in another order, and a fold with nothing waiting changes nothing.
    """
    base, newest, stale = _changes(spark, sf)
    root = scratch(spark, "orders-changes")
    log = changelog.ChangeLog(f"{root}/table", "o_orderkey", "seq", "op")
    changelog.create(log, base)
    half, out = F.col("o_orderkey") % 2 == 0, None

    def state(name):
        nonlocal out
        # Later steps replace the files, so each state is kept as it is.
        kept = f"{root}/states/{name.replace(' ', '-')}"
        changelog.live(log, spark).select(F.lit(name).alias("state"), *base.columns).write.parquet(
            kept)
        rows = spark.read.parquet(kept)
        out = rows if out is None else out.unionByName(rows)

    def land(rows):
        rows.repartition(2).write.mode("append").parquet(f"{root}/in")
        stream = streams.file_stream(spark, f"{root}/in", rows.schema, max_files=1)
        changelog.land(log, stream, f"{root}/checkpoint")

    land(newest.filter(half).unionByName(stale.filter("o_orderkey % 3 = 0 AND o_orderkey % 2 = 0")))
    state("landed")
    changelog.fold(log, spark)
    state("folded")
    land(stale.unionByName(newest.filter(~half)).orderBy(F.hash("o_orderkey", "seq")))
    state("landed again")
    changelog.fold(log, spark)
    state("folded again")
    if changelog.fold(log, spark):
        raise ValueError("a batch was folded twice")
    changelog.retire(log, spark)
    state("folded once more")
    return out


_LATE_PARTS = """
    timed AS (
      SELECT *, CASE WHEN event_id % 50 = 0 THEN 4
                     ELSE CAST(floor(3 * (epoch(ts) - (SELECT min(epoch(ts)) FROM events))
                       / (SELECT max(epoch(ts)) - min(epoch(ts)) + 1 FROM events)) AS INTEGER)
                END AS landing
      FROM events),
    marks AS (SELECT landing, max(ts) AS latest FROM timed GROUP BY landing),
    judged AS (
      SELECT event_id, event_type, date_trunc('day', ts) AS window_start,
             coalesce(date_trunc('day', ts) + INTERVAL 1 DAY <= (
               SELECT max(latest) FROM marks WHERE marks.landing < timed.landing)
               - INTERVAL 1 HOUR, FALSE) AS late
      FROM timed)"""


@query("stream_clickstream_late", f"""
    WITH {_LATE_PARTS}
    SELECT 'counted' AS outcome, window_start, event_type, count(*) AS n, NULL::BIGINT AS event_id
      FROM judged WHERE NOT late GROUP BY ALL
    UNION ALL SELECT 'late', window_start, event_type, 1, event_id FROM judged WHERE late""")
def stream_clickstream_late(spark, sf):
    """Events in order of time in three landings, and every fiftieth event in a fourth."""
    events = table(spark, sf, "events")
    ends = events.agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))).alias("lo"),
                      F.max(F.unix_micros(F.col("ts").cast("timestamp"))).alias("hi")).first()
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    third = F.floor(3 * (micros - ends.lo) / (ends.hi - ends.lo + 1_000_000)).cast("int")
    landing = F.when(F.col("event_id") % 50 == 0, 4).otherwise(third)
    root = scratch(spark, "late")
    for k in (0, 1, 2, 4):
        events.filter(landing == k).write.mode("append").parquet(f"{root}/in")
        stream = streams.file_stream(spark, f"{root}/in", events.schema, max_files=MAX_FILES)
        streams.windows_with_late(stream, f"{root}/out", f"{root}/checkpoint", "ts", "event_type")
    counted = streams.counted_windows(spark, f"{root}/out").select(
        F.lit("counted").alias("outcome"), F.col("window_start").cast("timestamp_ntz")
        .alias("window_start"), F.col("type").alias("event_type"), "n",
        F.lit(None).cast("long").alias("event_id"))
    late = spark.read.parquet(f"{root}/out/late").select(
        F.lit("late").alias("outcome"), F.date_trunc("day", "ts").cast("timestamp_ntz")
        .alias("window_start"), "event_type", F.lit(1).cast("long").alias("n"), "event_id")
    return counted.unionByName(late)


@query("stream_to_lake_files", """
    SELECT CAST(ts AS DATE) AS dt, count(*) AS n, TRUE AS few_files FROM events GROUP BY ALL""")
def stream_to_lake_files(spark, sf):
    """Rows by day, landed in three batches, and whether a day has two files for each batch at most:
    its range can end in one task and go on in the next. A second run with nothing new adds nothing."""
    events = table(spark, sf, "events")
    root = scratch(spark, "lake-files")
    events.repartition(6).write.parquet(f"{root}/in")
    for _ in range(2):
        stream = streams.file_stream(spark, f"{root}/in", events.schema, max_files=2)
        streams.land_lake(stream, f"{root}/lake", f"{root}/checkpoint", "ts", ["dt"])
    return spark.read.parquet(f"{root}/lake").groupBy("dt").agg(
        F.count(F.lit(1)).alias("n"),
        (F.count_distinct("_metadata.file_path") <= 2 * F.count_distinct("batch")).alias("few_files"))
