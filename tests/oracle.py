"""Compare a Spark query with its SQL twin, value by value."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

from plumbline.session import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else ("float", v + 0.0)
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, Decimal):
        return ("decimal", v.normalize() + 0)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, Counter(tuple(_norm(r[c]) for c in cols) for r in df.select(
        *[f"`{c}`" for c in cols]).collect())


def sql_rows(con, sql):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(_norm(r[i]) for i in order) for r in rel.fetchall())


def difference(df, con, sql) -> str | None:
    """None when equal, else a short account of what differs."""
    sc, sr = spark_rows(df)
    dc, dr = sql_rows(con, sql)
    if sc != dc:
        return f"columns {sc} != {dc}"
    if sr != dr:
        only_s, only_d = sr - dr, dr - sr
        return (f"rows {sum(sr.values())} / {sum(dr.values())}; only spark {sum(only_s.values())}: "
                f"{list(only_s)[:2]}; only sql {sum(only_d.values())}: {list(only_d)[:2]}")
    return None
