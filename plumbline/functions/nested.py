"""Counting and reshaping inside array, map and JSON columns, without exploding them.

A null array counts as empty: size and sums give 0, not null.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.functions.canonical import free_name, quoted


def size0(arr: Column) -> Column:
    return F.coalesce(F.size(arr), F.lit(0))


def has_items(arr: Column) -> Column:
    return F.when(size0(arr) > 0, 1).otherwise(0)


def count_if(arr: Column, cond: Callable[[Column], Column]) -> Column:
    return size0(F.filter(arr, cond))


def sum_sizes(arr: Column, inner: Callable[[Column], Column]) -> Column:
    total = F.aggregate(arr, F.lit(0), lambda acc, item: acc + size0(inner(item)))
    return F.coalesce(total, F.lit(0))


def item_rollup(df: DataFrame, by: str, items: str = "items") -> DataFrame:
    """Requests, items, flagged items and events per group; one shuffle on ``by``."""
    arr = F.col(items)
    rows = df.select(
        by,
        F.lit(1).alias("requests"),
        has_items(arr).alias("with_item"),
        count_if(arr, lambda x: x.flag).alias("with_flag"),
        size0(arr).alias("items"),
        count_if(arr, lambda x: x.flag).alias("flagged"),
        sum_sizes(arr, lambda x: x.event).alias("events"),
    )
    return rows.groupBy(by).agg(
        F.sum("requests").alias("total_requests"),
        F.sum("with_item").alias("total_requests_with_item"),
        F.sum("with_flag").alias("total_requests_with_item_flag_true"),
        F.sum("items").alias("total_items"),
        F.sum("flagged").alias("total_flagged_items"),
        F.sum("events").alias("total_events_on_items"),
    )


def json_fields(df: DataFrame, json_col: str, fields: Mapping[str, str]) -> DataFrame:
    """Add one column per (name, type), read from a JSON object column in one parse."""
    ddl = ", ".join(f"{quoted(name)} {dtype}" for name, dtype in fields.items())
    name = free_name("_json", df)
    parsed = df.withColumn(name, F.from_json(F.col(quoted(json_col)), ddl))
    return parsed.select(*[F.col(quoted(c)) for c in df.columns],
                         *[F.col(f"{name}.{quoted(n)}").alias(n) for n in fields])


def sort_json_keys(text: Column) -> Column:
    """A flat JSON object with its keys in order, for comparing; scalars become strings."""
    entries = F.map_entries(F.from_json(text, "map<string,string>"))
    return F.to_json(F.map_from_entries(F.array_sort(entries)))


def to_map_of_samples(samples: DataFrame, by: list[str], key: str, per_key: int) -> DataFrame:
    """Rows of ``samples`` as one map per group: key value -> list of the other columns.

    A list holds the first ``per_key`` rows of its (group, key) in the order of their values; the
    others are cut off before anything is collected, so each list is bounded.
    """
    cols = lambda names: [F.col(quoted(c)) for c in names]
    rest = [c for c in samples.columns if c not in by and c != key]
    place, rows = free_name("place", samples), free_name("rows", samples)
    first = Window.partitionBy(*cols([*by, key])).orderBy(*cols(rest))
    kept = samples.withColumn(place, F.row_number().over(first)).filter(F.col(place) <= per_key)
    lists = kept.groupBy(*cols([*by, key])).agg(
        F.array_sort(F.collect_list(F.struct(*cols(rest)))).alias(rows)
    )
    pairs = F.struct(F.col(quoted(key)), F.col(rows).alias("rows"))
    return lists.groupBy(*cols(by)).agg(
        F.map_from_entries(F.array_sort(F.collect_list(pairs))).alias("samples")
    )
