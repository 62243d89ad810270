"""Reconciliation options kept as rows: (left_tbl, right_tbl, arg_name, arg_dt, arg_val, user_id)."""

from __future__ import annotations

import dataclasses
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.relational import upsert
from plumbline.spec import ReconSpec

CONFIG_SCHEMA = """
    left_tbl string, right_tbl string, arg_name string, arg_dt string, arg_val string,
    user_id string
"""
CONFIG_KEYS = ("left_tbl", "user_id", "arg_name")

# Options that are kept per table; the others belong to a run.
SAVED_OPTIONS = (
    "keys", "exclude", "exclude_left", "exclude_right", "rename", "column_exprs", "type_exprs",
    "sort_json", "where",
)


def config_rows(cfg: DataFrame, table: str, user: str) -> DataFrame:
    """Saved options of a table and user; names compare without case and outer blanks.

    ``user_id`` is the partition column. Its comparison ignores case, so Spark prunes by
    evaluating the expression on the partition values.
    """
    return cfg.filter(
        (F.lower(F.trim("user_id")) == user.strip().lower())
        & (F.lower(F.trim("left_tbl")) == table.strip().lower())
    ).select(F.lower(F.trim("arg_name")).alias("arg_name"), "arg_dt", "arg_val")


def config_load(cfg: DataFrame, table: str, user: str, passed: Mapping[str, object]) -> dict:
    """Options for a run: the passed ones win, saved ones fill in, unknown ones are skipped.

    Two different saved values of one option are an error.
    """
    known = {f.name for f in dataclasses.fields(ReconSpec)}
    out = dict(passed)
    rows = config_rows(cfg, table, user).filter(F.col("arg_name").isin(sorted(known))).distinct()
    seen = set()
    for row in rows.collect():  # at most one row per option
        if row.arg_name in seen:
            raise ValueError(f"{table} has several saved values of {row.arg_name} for {user}")
        seen.add(row.arg_name)
        if row.arg_name in passed:
            continue
        out[row.arg_name] = row.arg_val if row.arg_dt == "str" else json.loads(row.arg_val)
    return out


def spec_rows(
    spark: SparkSession, left_tbl: str, right_tbl: str, spec: ReconSpec, user: str | None = None
) -> DataFrame:
    """The options of a spec as config rows, plus the whole spec as one JSON blob."""
    saved = {name: getattr(spec, name) for name in SAVED_OPTIONS}
    plain = {k: dict(v) if isinstance(v, Mapping) else v if isinstance(v, str) else list(v)
             for k, v in saved.items()}
    rows = [
        (k, type(v).__name__, v if isinstance(v, str) else json.dumps(v, sort_keys=True))
        for k, v in plain.items()
    ]
    rows.append(("cfg_json", "str", json.dumps(plain, sort_keys=True)))
    out = spark.createDataFrame(rows, "arg_name string, arg_dt string, arg_val string")
    owner = F.current_user() if user is None else F.lit(user)
    return out.select(
        F.lit(left_tbl).alias("left_tbl"), F.lit(right_tbl).alias("right_tbl"),
        "arg_name", "arg_dt", "arg_val", owner.alias("user_id"),
    )


def config_save(cfg: DataFrame, new: DataFrame) -> DataFrame:
    """The config table with the new rows put in: updated where present, else added.

    Names compare without case and outer blanks, as they do in :func:`config_rows`.
    """
    keys = [f"key_{c}" for c in CONFIG_KEYS]

    def keyed(df: DataFrame) -> DataFrame:
        return df.select("*", *[F.lower(F.trim(c)).alias(k)
                                for c, k in zip(CONFIG_KEYS, keys, strict=True)])

    return upsert(keyed(cfg), keyed(new), keys).drop(*keys)


def json_option_rows(cfg: DataFrame, names: Sequence[str]) -> DataFrame:
    """Options named inside the saved JSON blobs, as rows of their own."""
    wide = cfg.filter("arg_name = 'cfg_json'").select(
        "left_tbl", "right_tbl", "user_id",
        *[F.get_json_object("arg_val", f"$.{n}").alias(n) for n in names],
    )
    long = wide.unpivot(["left_tbl", "right_tbl", "user_id"], list(names), "arg_name", "arg_val")
    kind = (
        F.when(F.col("arg_val").startswith("{"), "dict")
        .when(F.col("arg_val").startswith("["), "list")
        .otherwise("str")
    )
    return long.filter("arg_val IS NOT NULL").select(
        "left_tbl", "right_tbl", "arg_name", kind.alias("arg_dt"), "arg_val", "user_id"
    )


def config_json_to_rows(cfg: DataFrame, names: Sequence[str]) -> DataFrame:
    """The config table with the named blob keys promoted to rows, which replace rows of that name."""
    return config_save(cfg, json_option_rows(cfg, names))


def config_migrate(
    old: DataFrame, names: Sequence[str] = SAVED_OPTIONS, blob: str = "cfg_json"
) -> DataFrame:
    """A wide config table (one column per option) as long rows.

    Arrays become JSON text, text stays, and an option without a column of its own is read
    from the JSON blob. Options without a value give no row.
    """
    types = dict(old.dtypes)
    if blob not in types:
        raise ValueError(f"no {blob} column: the table is already in long form")
    cols = []
    for name in [*names, blob]:
        if name not in types:
            cols.append(F.get_json_object(blob, f"$.{name}").alias(name))
        elif types[name] == "string":
            cols.append(F.col(name))
        elif types[name].startswith(("array", "map", "struct")):
            cols.append(F.to_json(name).alias(name))
        else:
            raise ValueError(f"option column {name} has type {types[name]}")
    ids = ["left_tbl", "right_tbl", "user_id"]
    long = old.select(*ids, *cols).unpivot(ids, [*names, blob], "arg_name", "arg_val")
    kind = (
        F.when(F.col("arg_val").startswith("{") & (F.col("arg_name") != blob), "dict")
        .when(F.col("arg_val").startswith("["), "list")
        .otherwise("str")
    )
    return long.filter("arg_val IS NOT NULL").select(
        "left_tbl", "right_tbl", "arg_name", kind.alias("arg_dt"), "arg_val", "user_id"
    )
