"""Whole reconciliation runs: the report of one pair, many pairs, history and drill-down."""

from __future__ import annotations

import contextlib
import dataclasses
import io
import traceback
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import recon
from plumbline.spec import ReconSpec, TableSpec, as_frame, precheck, prepare

REPORT_SCHEMA = "check string, passed boolean, metric string, value long, detail string"

SUMMARY_SCHEMA = """
    left_tbl string, right_tbl string, report_ts timestamp, passed boolean,
    primary_keys array<string>,
    duplicate_pk_left_count long, duplicate_pk_right_count long,
    count_check_passed boolean, count_left long, count_right long,
    schema_check_passed boolean, schema_left_col_count long, schema_right_col_count long,
    schema_mismatched_cols string,
    hash_check_passed boolean, hash_row_diff long,
    cell_check_passed boolean,
    mismatched_rows map<string, array<struct<key: string, left_val: string, right_val: string>>>,
    comments string
"""


class CheckFailed(RuntimeError):
    """Raised at the first failing check when the options ask for it."""


@dataclass
class ReconResult:
    """Outcome of one pair. ``samples`` stays a lazy DataFrame."""

    passed: bool
    checks: dict[str, bool]
    metrics: dict[str, dict[str, int]]
    details: dict[str, list[str]]
    samples: DataFrame | None = None
    plans: dict[str, str] = field(default_factory=dict)

    def rows(self) -> list[tuple]:
        out = []
        for check, ok in self.checks.items():
            detail = ", ".join(self.details.get(check, []))
            for metric, value in self.metrics.get(check, {}).items():
                out.append((check, ok, metric, int(value), detail))
        return out

    def report(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), REPORT_SCHEMA)


def verdict(checks: Mapping[str, bool], has_keys: bool) -> bool:
    """Passed = hash, schema and counts pass, and the cell check too when there are keys."""
    needed = ["hash", "schema", "counts"] + (["cells"] if has_keys else [])
    return all(checks.get(c) is True for c in needed)


def _plan_text(df: DataFrame) -> str:
    """Spark's formatted plan. The only public way to get it as text is its printout."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


class _Run:
    """Collects check outcomes in order and stops at the first failure if asked to."""

    def __init__(self, spec: ReconSpec) -> None:
        self.spec = spec
        self.result = ReconResult(False, {}, {}, {})

    def plan(self, check: str, df: DataFrame) -> DataFrame:
        if self.spec.include_plans:
            self.result.plans[check] = _plan_text(df)
        return df

    def done(self, check: str, ok: bool, metrics: dict[str, int], details: Iterable[str] = ()):
        self.result.checks[check] = ok
        self.result.metrics[check] = metrics
        self.result.details[check] = list(details)
        if not ok and self.spec.stop_on_failure:
            raise CheckFailed(f"{check}: {metrics} {list(details)}")


def reconcile(
    left: DataFrame | str, right: DataFrame | str, spec: ReconSpec, spark: SparkSession | None = None
) -> ReconResult:
    """Run the chosen checks on one pair of tables.

    Jobs: one pass over keys and row fingerprints (row counts, repeated, one-sided and differing
    keys, and row hashes together), and one that fetches the rows of the keys that need a look; so
    each side is read twice. Only totals reach the driver. With ``stop_on_failure`` rows are counted before anything costly.
    """
    spark = spark or (left if isinstance(left, DataFrame) else right).sparkSession
    left, right = as_frame(spark, left), as_frame(spark, right)
    lhs, rhs = prepare(left, spec, "left"), prepare(right, spec, "right")
    precheck(lhs, rhs, spec)
    rhs = rhs.select(*lhs.columns)
    run, keys, chosen = _Run(spec), list(spec.keys), set(spec.checks)

    if "schema" in chosen:
        _schema(run, left, right, spec)
    found = totals = None
    if "counts" in chosen and spec.stop_on_failure:  # the cheap check first, to stop at it
        rows = {r.side: r.row_count for r in recon.check_counts(lhs, rhs).collect()}
        run.done("counts", rows["left"] == rows["right"], rows)
        chosen.discard("counts")
    if keys and "cells" in chosen:
        found = recon.scan_keys(lhs, rhs, keys)
        totals = found.totals
    elif keys and chosen & {"counts", "dup_keys", "exclusive_keys"}:
        census = run.plan("census", recon.census_totals(recon.key_census(lhs, rhs, keys)))
        totals = census.first().asDict()
    if "counts" in chosen:
        if totals is None:
            rows = {r.side: r.row_count for r in recon.check_counts(lhs, rhs).collect()}
        else:
            rows = {"left": totals["rows_left"], "right": totals["rows_right"]}
        run.done("counts", rows["left"] == rows["right"], rows)
    if found is not None:
        rows = recon.fetch(lhs, rhs, found)
        if "hash" in chosen:
            run.plan("hash", found.scan)  # the row hashes come from the key scan
    if "hash" in chosen:
        hashed = recon.hash_differences(*rows, found) if found is not None else run.plan(
            "hash", recon.check_hash(lhs, rhs)).first().asDict()
        run.done("hash", not any(hashed.values()), hashed)
    if keys and "dup_keys" in chosen:
        dup = {"left": totals["dup_left"], "right": totals["dup_right"]}
        run.done("dup_keys", not any(dup.values()),
                 {**dup, "repeated_on_both": totals["repeated_both"]})
    if keys and "exclusive_keys" in chosen:
        only = {"left": totals["only_left"], "right": totals["only_right"]}
        run.done("exclusive_keys", not any(only.values()), only)
    if "cells" in chosen:
        _cells(run, *(rows if found is not None else (lhs, rhs)), found)
    run.result.passed = verdict(run.result.checks, bool(keys))
    return run.result


def _schema(run: _Run, left: DataFrame, right: DataFrame, spec: ReconSpec) -> None:
    """Types as they are in the tables (filters and expressions aside), after renaming."""
    lraw = prepare(left, _types_only(spec), "left").schema
    rraw = prepare(right, _types_only(spec), "right").schema
    bad = [f"{n}: {lt} / {rt}" for n, lt, rt, ok in recon.schema_rows(lraw, rraw) if not ok]
    run.done("schema", not bad, {
        "left_cols": len(TableSpec.of(lraw).columns),
        "right_cols": len(TableSpec.of(rraw).columns),
        "mismatched": len(bad),
    }, bad)


def _types_only(spec: ReconSpec) -> ReconSpec:
    return dataclasses.replace(spec, column_exprs={}, type_exprs={}, sort_json=(), where="")


def _cells(
    run: _Run, lhs: DataFrame, rhs: DataFrame, found: recon.KeyFindings | None
) -> None:
    n = run.spec.samples
    if found is None:  # no keys
        if n and not run.result.checks.get("hash", True):
            run.result.samples = recon.sample_unmatched(lhs, rhs, n)
        return
    keys = list(found.keys)
    diffs = recon.cell_diff(lhs, rhs, keys, found)
    if n:
        diffs = diffs.persist(StorageLevel.MEMORY_AND_DISK)  # only the differing rows
    try:
        counts = run.plan("cells", recon.check_cells(lhs, rhs, keys, found, diffs))
        wrong = {r.col_name: r.mismatch_cnt for r in counts.collect()}  # one row per column
        run.done("cells", not wrong, wrong or {"mismatched": 0}, sorted(wrong))
        if n and wrong:
            picked = recon.diff_samples(lhs, rhs, keys, n, found, diffs)
            rows = picked.collect()  # at most n per column
            run.result.samples = lhs.sparkSession.createDataFrame(rows, picked.schema)
    finally:
        if n:
            diffs.unpersist()


# --- many pairs -----------------------------------------------------------------------

@dataclass(frozen=True)
class Pair:
    left_tbl: str
    right_tbl: str
    left: DataFrame | str
    right: DataFrame | str
    spec: ReconSpec


def _summary_row(spark: SparkSession, pair: Pair, when: datetime) -> tuple:
    keys = list(pair.spec.keys)
    try:
        res = reconcile(pair.left, pair.right, pair.spec, spark)
        ok, got, comment = res.checks, res.metrics, None
        passed = res.passed
        samples = _samples_map(res, keys)
        if ok.get("hash") is False:
            comment = "row hashes differ"
        if keys and ok.get("cells") is False:
            comment = "cells differ in: " + ", ".join(res.details["cells"])
        details = ", ".join(res.details.get("schema", []))
    except Exception as e:  # one failing pair must not stop the rest
        ok, got, passed, samples, details = {}, {}, False, None, None
        comment = "ERROR: " + "".join(traceback.format_exception_only(e)).strip()
    def num(check: str, metric: str):
        return got.get(check, {}).get(metric)

    return (
        pair.left_tbl, pair.right_tbl, when, passed, keys,
        num("dup_keys", "left"), num("dup_keys", "right"),
        ok.get("counts"), num("counts", "left"), num("counts", "right"),
        ok.get("schema"), num("schema", "left_cols"), num("schema", "right_cols"), details,
        ok.get("hash"), num("hash", "row_diff"), ok.get("cells"), samples, comment,
    )


def _samples_map(res: ReconResult, keys: list[str]) -> dict | None:
    if res.samples is None or not keys:
        return None
    out: dict[str, list[tuple]] = {}
    for r in res.samples.collect():  # at most n rows per column
        key = " | ".join("null" if r[k] is None else str(r[k]) for k in keys)
        out.setdefault(r.col_name, []).append((key, r.left_val, r.right_val))
    return out


def reconcile_many(
    spark: SparkSession, pairs: Iterable[Pair], when: datetime | None = None
) -> DataFrame:
    """One typed summary row per pair; a pair that raises becomes a row with the error."""
    when = when or datetime.now(timezone.utc)
    return spark.createDataFrame([_summary_row(spark, p, when) for p in pairs], SUMMARY_SCHEMA)


# --- drill-down -----------------------------------------------------------------------

def guess_join_columns(names: Sequence[str]) -> list[str]:
    """All columns whose names end in ``_dt`` or ``_id``."""
    return [n for n in names if n.lower().endswith(("_dt", "_id"))]


def drilldown(
    mismatches: DataFrame,
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    cols: Sequence[str],
    n: int = 100,
) -> DataFrame:
    """Both sides' rows for the mismatched keys, side by side, first n in column order.

    A key that a side lacks shows as a row of nulls there. The key list is made distinct
    first, so a key sampled for several columns is looked up once. A semi join finds the
    rows, since a hot key of the table can be split there and not in an outer join; the
    absent keys come from an anti join against the table's distinct keys.
    """
    wanted = mismatches.select(*on).distinct()

    def side(df: DataFrame, name: str) -> DataFrame:
        cond = recon.same_on("t", "m", on)
        found = df.alias("t").join(wanted.alias("m"), cond, "left_semi").select(*cols)
        present = df.select(*on).distinct().alias("t")
        nulls = [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in cols]
        absent = wanted.alias("m").join(present, cond, "left_anti").select(*nulls)
        both = found.unionByName(absent)
        return both.select(F.lit(name).alias("side"), *cols)

    both = side(left, "left").unionByName(side(right, "right"))
    return both.orderBy(*both.columns).limit(n)
