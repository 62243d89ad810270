"""A table kept by change rows: a base of Parquet files, and landed batches of changes on top.

The base holds each key's last folded change with its number, deletions too, so that a stale change
loses whenever it arrives. Its version names the batches that are folded in; folding rewrites only
the base files that hold a changed key and ends with one write, the next version. Until then, and
after a failure, readers see the old base and all batches beside it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.canonical import quoted
from plumbline.operators.recon import with_keys
from plumbline.session import exists, remove
from plumbline.sources import manifest
from plumbline.streaming.streams import land_changes, newest_changes


@dataclass(frozen=True)
class ChangeLog:
    """``root/base`` and ``root/log``; rows have a key, a sequence number and an operation, where ``D``
    deletes."""

    root: str
    key: str
    seq: str
    op: str

    @property
    def base(self) -> str:
        return f"{self.root}/base"

    @property
    def landed(self) -> str:
        return f"{self.root}/log"


def create(log: ChangeLog, rows: DataFrame, seq_type: str = "long") -> None:
    """The base from rows without number and operation; any change is newer."""
    start = rows.withColumns({log.seq: F.lit(None).cast(seq_type), log.op: F.lit("I")})
    manifest.create(rows.sparkSession, log.base, start, [log.key], {"folded": []})


def land(log: ChangeLog, changes: DataFrame, checkpoint: str) -> None:
    """Land a stream of changes, each batch's newest change per key under its number."""
    land_changes(changes, log.landed, checkpoint, log.key, log.seq)


def _intervals(numbers: Sequence[int]) -> list[list[int]]:
    """Numbers as [first, last] runs: batches are numbered without gaps, so there are few."""
    out: list[list[int]] = []
    for n in sorted(set(numbers)):
        if out and n == out[-1][1] + 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return out


def _waiting(log: ChangeLog, spark: SparkSession, version: manifest.Version) -> DataFrame | None:
    """Changes of the batches that the base does not hold, with the column ``batch``."""
    if not exists(spark, log.landed):
        return None
    schema = T.StructType(version.schema.fields).add("batch", "long")
    rows = spark.read.schema(schema).parquet(log.landed)
    for first, last in version.note["folded"]:
        rows = rows.where(~F.col("batch").between(first, last))
    return rows


def live(log: ChangeLog, spark: SparkSession) -> DataFrame:
    """The table's rows, without number and operation: base and waiting batches merged.

    Only base rows of changed keys are compared; the others pass through an anti join against the
    changed keys, and without waiting batches the base is just read.
    """
    version = manifest.current(spark, log.base)
    base, waiting = manifest.read(spark, version), _waiting(log, spark, version)
    if waiting is not None:
        changes = newest_changes(waiting.drop("batch"), log.key, log.seq)
        keys = changes.select(quoted(log.key))
        known = with_keys(base, keys, [log.key], "left_semi").unionByName(changes)
        base = with_keys(base, keys, [log.key], "left_anti").unionByName(
            newest_changes(known, log.key, log.seq))
    shown = [c for c in version.schema.names if c not in (log.seq, log.op)]
    return base.where(~F.col(quoted(log.op)).eqNullSafe(F.lit("D"))).select(
        *[F.col(quoted(c)) for c in shown])


def fold(log: ChangeLog, spark: SparkSession) -> list[int]:
    """Put the waiting batches into the base; the numbers of the batches that went in.

    A fold that failed left the old version, so it is just run again; with nothing waiting it does
    nothing. Batches that land meanwhile wait for the next fold.
    """
    version = manifest.current(spark, log.base)
    waiting = _waiting(log, spark, version)
    batches = [] if waiting is None else [
        r.batch for r in waiting.select("batch").distinct().collect()]
    if not batches:
        return []
    changes = newest_changes(waiting.where(F.col("batch").isin(batches)).drop("batch"), log.key,
                             log.seq)
    folded = _intervals([n for a, b in version.note["folded"] for n in range(a, b + 1)] + batches)

    def merged(rows: DataFrame) -> DataFrame:
        return newest_changes(rows.unionByName(changes), log.key, log.seq)

    manifest.rewrite(spark, log.base, changes, [log.key], merged, {"folded": folded})
    return sorted(batches)


def retire(log: ChangeLog, spark: SparkSession) -> None:
    """Delete landed batches that the base holds, and bases before the current one.

    The numbers of the batches stay in the version, so a batch that lands again is not taken again.
    """
    version = manifest.current(spark, log.base)
    for first, last in version.note["folded"]:
        for n in range(first, last + 1):
            remove(spark, f"{log.landed}/batch={n}")
    manifest.retire(spark, log.base)
