"""The file-wise table and the change log over it."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from plumbline.session import scratch
from plumbline.sources import manifest
from plumbline.streaming import changelog

SCHEMA = "`a.id` long, k string, file string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def table(spark, ids, mark="old"):
    return spark.createDataFrame([(i, f"k{i}", mark) for i in ids], SCHEMA)


def test_upsert_rewrites_only_touched_files(spark):
    root = scratch(spark, "t")
    manifest.create(spark, root, table(spark, range(100)), ["a.id"])
    old = manifest.append(spark, root, table(spark, range(200, 300)))
    source = table(spark, [250, 400], "new").union(spark.createDataFrame(
        [(None, "null", "new")], SCHEMA))
    new = manifest.upsert_files(spark, root, source, ["a.id"])
    want = [(i, f"k{i}", "old") for i in [*range(100), *range(200, 250), *range(251, 300)]]
    want += [(250, "k250", "new"), (400, "k400", "new"), (None, "null", "new")]
    assert rows(manifest.read(spark, new)) == sorted(want, key=str)
    stay = {f.file for f in old.files if f.hi[0] < 250 or f.lo[0] > 250}
    assert stay and stay <= new.names
    assert not {f.file for f in old.files if f.lo[0] <= 250 <= f.hi[0]} & new.names
    assert rows(manifest.read(spark, old)) != rows(manifest.read(spark, new))  # old readers go on
    with pytest.raises(ValueError):
        manifest.upsert_files(spark, root, table(spark, [1, 1]), ["a.id"])
    gone = manifest.delete_files(spark, root, table(spark, range(0, 300, 2)), ["a.id"])
    assert all(r[0] is None or r[0] % 2 or r[0] == 400 for r in rows(manifest.read(spark, gone)))


def test_two_writers_of_one_version(spark):
    root = scratch(spark, "t")
    old = manifest.create(spark, root, table(spark, range(3)), ["a.id"])
    manifest.append(spark, root, table(spark, [5]))
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        manifest._publish(spark, root, manifest.Version(1, old.files, old.keys, old.schema, {}))
    assert manifest.current(spark, root).number == 1


def test_empty_table_and_odd_keys(spark):
    root = scratch(spark, "t")
    empty = manifest.create(spark, root, table(spark, []), ["a.id"])
    assert not empty.files and manifest.read(spark, empty).columns == ["a.id", "k", "file"]
    assert manifest.overlap_depth(spark, empty) == 0
    new = manifest.upsert_files(spark, root, table(spark, [1]), ["a.id", "k"])
    assert rows(manifest.read(spark, new)) == [(1, "k1", "old")]
    root = scratch(spark, "t")  # doubles are not narrowed: NaN has its own order
    df = spark.createDataFrame([(float("nan"), 1), (1.0, 2), (None, 3)], "x double, n int")
    manifest.create(spark, root, df, ["x"])
    put = spark.createDataFrame([(float("nan"), 9)], "x double, n int")
    assert {r[1] for r in rows(manifest.read(spark, manifest.upsert_files(
        spark, root, put, ["x"])))} == {9, 2, 3}


def test_recluster_sorts_what_overlaps(spark):
    root = scratch(spark, "t")
    manifest.create(spark, root, table(spark, range(50)), ["a.id"])
    manifest.append(spark, root, table(spark, range(100, 200, 2)))
    manifest.append(spark, root, table(spark, range(1000, 1010)))
    old = manifest.append(spark, root, table(spark, range(101, 201, 2)))
    assert manifest.overlap_depth(spark, old) > 1
    new = manifest.recluster(spark, root)
    assert manifest.overlap_depth(spark, new) == 1
    clean = {f.file for f in old.files if f.hi[0] < 100 or f.lo[0] >= 1000}
    assert clean <= new.names
    assert rows(manifest.read(spark, new)) == rows(manifest.read(spark, old))
    assert manifest.recluster(spark, root).number == new.number
    manifest.retire(spark, root)
    assert rows(manifest.read(spark, manifest.current(spark, root))) == rows(
        manifest.read(spark, new))


def test_folding_equals_newest_change(spark):
    """Random changes in random batches, folded at random: always the newest change per key."""
    draw = random.Random(4)
    log = changelog.ChangeLog(scratch(spark, "log"), "id", "seq", "op")
    schema = "seq long, op string, id long, v string"
    state = {i: (-1, "I", f"v{i}") for i in range(20)}
    changelog.create(log, spark.createDataFrame([(i, f"v{i}") for i in range(20)],
                                                "id long, v string"))
    for batch in range(4):
        new = [(draw.randint(0, 60), draw.choice("IUD"), draw.randint(0, 30), f"b{batch}.{n}")
               for n in range(12)]
        for seq, op, key, value in new:
            if key not in state or seq > state[key][0]:
                state[key] = (seq, op, value)
        unique = {(r[0], r[2]): r for r in new}.values()
        if len(unique) < len(new):  # equal numbers for one key go by the row's mark: not drawn here
            new = list(unique)
            for seq, op, key, value in new:
                if state[key][0] == seq:
                    state[key] = (seq, op, value)
        from plumbline.streaming.streams import newest_changes
        df = spark.createDataFrame(new, schema)
        newest_changes(df, "id", "seq").write.mode("overwrite").parquet(
            f"{log.landed}/batch={batch}")
        if batch % 2:
            assert changelog.fold(log, spark) == [batch - 1, batch]
            assert changelog.fold(log, spark) == []
        want = sorted((k, v) for k, (_, op, v) in state.items() if op != "D")
        assert rows(changelog.live(log, spark)) == sorted(want, key=str)
    changelog.retire(log, spark)
    assert rows(changelog.live(log, spark)) == sorted(want, key=str)
    assert manifest.current(spark, log.base).note["folded"] == [[0, 3]]


def test_a_failed_fold_changes_nothing(spark, monkeypatch):
    log = changelog.ChangeLog(scratch(spark, "log"), "id", "seq", "op")
    changelog.create(log, spark.createDataFrame([(1, "a"), (None, "n")], "id long, v string"))
    spark.createDataFrame([(1, "U", 1, "b"), (1, "U", None, "m")],
                          "seq long, op string, id long, v string").write.parquet(
        f"{log.landed}/batch=0")
    before = rows(changelog.live(log, spark))
    assert before == [(1, "b"), (None, "m")]  # null keys are one key of the log

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(manifest, "_publish", fail)
        with pytest.raises(RuntimeError):
            changelog.fold(log, spark)
    assert rows(changelog.live(log, spark)) == before


def test_late_rows_and_counts_are_the_input(spark):
    from plumbline.streaming import streams

    root = scratch(spark, "late")
    at = lambda d, h: datetime(2024, 1, d, h)
    landings = [[(1, at(1, 1)), (2, at(1, 23)), (3, at(2, 0))],
                [(4, at(1, 2)), (5, at(2, 3)), (6, None)],  # the first day is still open
                [(7, at(1, 5)), (8, at(2, 23)), (9, at(4, 0))],  # and now it has ended
                [(10, at(2, 1)), (11, at(3, 0)), (12, at(4, 1))]]
    for part in landings:
        spark.createDataFrame(part, "n long, ts timestamp").withColumn("kind", F.lit("x")).write.mode(
            "append").parquet(f"{root}/in")
        stream = streams.file_stream(spark, f"{root}/in", "n long, ts timestamp, kind string")
        streams.windows_with_late(stream, f"{root}/out", f"{root}/checkpoint", "ts", "kind")
    late = {r.n for r in spark.read.parquet(f"{root}/out/late").collect()}
    counts = {r.window_start.day: r.n for r in streams.counted_windows(
        spark, f"{root}/out").collect()}
    assert late == {6, 7, 10}
    assert counts == {1: 3, 2: 3, 3: 1, 4: 2}
    still = spark.read.parquet(f"{root}/out/open").where("batch = 3").collect()
    assert [r.window_start.day for r in still] == [4]  # all that a next batch needs


def test_a_later_batch_of_an_hour_is_added(spark):
    from plumbline.sources import sinks

    path = scratch(spark, "hive")
    ts = datetime(2024, 1, 1, 5, 30)
    for n, batch in ((1, 1), (2, 2), (2, 2)):
        sinks.sink_hive_layout(spark.createDataFrame([(n, ts)], "n long, ts timestamp"), path, "ts",
                               batch)
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [1, 2]
    with pytest.raises(ValueError):
        sinks.sink_hive_layout(spark.createDataFrame([(1, ts)], "batch long, ts timestamp"), path,
                               "ts")
