"""Registry of the runnable queries: name -> Spark function, with its SQL twin where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query. ``sql`` gives the same rows on the same tables in another engine."""
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def load_all() -> None:
    """Import every module that registers queries."""
    from plumbline.plans import (  # noqa: F401
        q_html, q_recon, q_relational, q_reshape, q_sinks, q_sources, q_streaming, q_warehouse,
    )
