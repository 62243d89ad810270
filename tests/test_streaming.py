import random

import pytest
from pyspark.sql import functions as F

from plumbline.session import scratch, table
from plumbline.streaming import streams


def test_each_landed_file_is_read_once(spark):
    src, out, mark = (scratch(spark, x) for x in ("src", "out", "mark"))
    spark.range(10).repartition(3).write.parquet(src)
    go = lambda: streams.run_available(
        streams.file_stream(spark, src, "id bigint", max_files=1), out, mark)
    go()
    go()
    assert spark.read.parquet(out).count() == 10
    spark.range(10, 15).write.mode("append").parquet(src)
    go()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(15))


def test_typed_or_bad(spark):
    df = spark.createDataFrame([("1", "2024-01-01"), ("x", "soon"), (None, None)], "n string, d string")
    got = [(r.n, r.bad_columns) for r in streams.typed_or_bad(df, {"n": "int", "d": "date"}).collect()]
    assert got == [(1, ""), (None, "n,d"), (None, "")]


def test_decode_bytes(spark):
    df = spark.sql("""SELECT CAST('{"a": 1}' AS BINARY) AS value UNION ALL SELECT CAST('bad' AS BINARY)""")
    assert {r.a for r in streams.decode_json(df, "value", "a int").collect()} == {1, None}


def test_clickstream_equals_the_batch_count(spark, sf):
    events = table(spark, sf, "events")
    src, out, mark = (scratch(spark, x) for x in ("clicks", "counts", "mark"))
    events.select("ts", "event_type").repartition(3).write.parquet(src)
    stream = streams.file_stream(spark, src, "ts timestamp_ntz, event_type string")
    streams.append_updates(
        streams.clickstream_counts(stream, "ts", "event_type", "6 hours"), out, mark)
    got = streams.latest_update(spark, out, ["window_start", "event_type"], "n")
    want = events.groupBy(F.window(F.col("ts").cast("timestamp"), "6 hours"), "event_type").count()
    want = want.select(F.col("window.start"), "event_type", "count")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_rows_behind_the_watermark_are_dropped(spark):
    src, out, mark = (scratch(spark, x) for x in ("late", "late-out", "late-mark"))
    def land(*times):
        spark.createDataFrame([(t, "a") for t in times], "t string, k string").select(
            F.to_timestamp_ntz("t").alias("ts"), "k").coalesce(1).write.mode("append").parquet(src)
        stream = streams.file_stream(spark, src, "ts timestamp_ntz, k string")
        streams.append_updates(
            streams.clickstream_counts(stream, "ts", "k", "1 hour", "1 hour"), out, mark)
    land("2024-01-01 00:10:00", "2024-01-01 05:00:00")
    land("2024-01-01 05:30:00")
    land("2024-01-01 00:20:00", "2024-01-01 05:40:00")
    got = {str(r.window_start): r.n for r in
           streams.latest_update(spark, out, ["window_start", "k"], "n").collect()}
    assert got == {"2024-01-01 00:00:00": 1, "2024-01-01 05:00:00": 3}


@pytest.mark.parametrize("seed", range(3))
def test_change_rows_in_any_order_give_the_newest_state(spark, seed):
    rnd = random.Random(seed)
    base = [(k, f"base{k}") for k in range(6)]
    changes = [(rnd.choice("IUD"), s, rnd.randint(0, 9), f"v{s}") for s in range(1, 30)]
    want = dict(base)
    for op, _, k, v in changes:
        if op == "D":
            want.pop(k, None)
        else:
            want[k] = v
    rnd.shuffle(changes)
    src, landed, mark = (scratch(spark, x) for x in ("chg", "chg-landed", "chg-mark"))
    ddl = "op string, seq long, k int, v string"
    table_df = spark.createDataFrame(base, "k int, v string")
    for part in (changes[:9], changes[9:20], changes[20:]):
        spark.createDataFrame(part, ddl).repartition(2).write.mode("append").parquet(src)
        streams.land_changes(streams.file_stream(spark, src, ddl, max_files=1), landed, mark, "k", "seq")
    live = streams.apply_changes(table_df, spark.read.parquet(landed), "k", "seq", "op")
    assert {r.k: r.v for r in live.collect()} == want and live.count() == len(want)


def test_kafka_options():
    opts = streams.kafka_options(["a:9092", "b:9092"], "sales", max_offsets=1000, min_partitions=64)
    assert opts["kafka.bootstrap.servers"] == "a:9092,b:9092" and opts["subscribe"] == "sales"
    assert (opts["maxOffsetsPerTrigger"], opts["minPartitions"]) == ("1000", "64")


def test_text_topic_is_landed_gzipped_and_read_whole(spark):
    import os

    from plumbline.plans import q_streaming

    rows = spark.createDataFrame([('{"uuid": "a"}',), ('{"uuid": "b',)], "value string")
    path = q_streaming._land(rows.repartition(2), spark, "topic", "text")
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert files and all(f.endswith(".txt.gz") for f in files)
    out = scratch(spark, "topic-out")
    streams.run_available(streams.file_stream(spark, path, "value string", "text"), out,
                          scratch(spark, "topic-mark"))
    assert sorted(r.value for r in spark.read.parquet(out).collect()) == ['{"uuid": "a"}', '{"uuid": "b']
