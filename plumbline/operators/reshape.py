"""Set operations and reshaping between wide, long and nested forms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def concat_keyed(frames: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Stack frames of one shape; the mapping's key becomes a column."""
    tagged = [df.select(F.lit(k).alias(key), *df.columns) for k, df in frames.items()]
    return reduce(DataFrame.unionByName, tagged)


def concat_loose(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames whose columns may differ; missing ones become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def schema_setdiff(spark: SparkSession, left: DataFrame, right: DataFrame) -> DataFrame:
    """(side, col_name) for columns that only one side has."""
    lc = {c.lower() for c in left.columns}
    rc = {c.lower() for c in right.columns}
    rows = [("left", c) for c in sorted(lc - rc)] + [("right", c) for c in sorted(rc - lc)]
    return spark.createDataFrame(rows, "side string, col_name string")


def unpivot_wide(
    df: DataFrame, ids: Sequence[str], names: Mapping[str, str], name_col: str, value_col: str
) -> DataFrame:
    """Columns to (name, value) rows under their aliases; nulls give no row."""
    values = [F.col(f"`{c}`").alias(alias) for c, alias in names.items()]
    wide = df.select(*ids, *values)
    long = wide.unpivot(list(ids), list(names.values()), name_col, value_col)
    return long.filter(F.col(value_col).isNotNull())


def explode_ragged(
    df: DataFrame, fields: str, group: str = "group_name", name: str = "name", pos: str = "pos"
) -> DataFrame:
    """Array rows (group, name, name, ...) to one (group, position, name) row per name."""
    rest = F.slice(F.col(fields), 2, F.greatest(F.size(fields) - 1, F.lit(0)))
    picked = df.select(F.element_at(fields, 1).alias(group), F.posexplode(rest).alias("_p", name))
    return picked.filter(F.col(name).isNotNull()).select(
        group, (F.col("_p") + 1).alias(pos), name
    )


def unpivot_options(
    df: DataFrame, ids: Sequence[str], prefix: str, number: str = "option_no",
    value: str = "option_text",
) -> DataFrame:
    """Numbered columns ``<prefix> 1 ... n`` to rows (ids, number, text); blanks give no row."""
    cols = [c for c in df.columns if c.startswith(prefix)]
    long = df.unpivot(list(ids), [F.col(f"`{c}`") for c in cols], "_name", value)
    no = F.regexp_extract("_name", r"(\d+)$", 1).cast("int")
    return long.filter(F.trim(value) != "").select(*ids, no.alias(number), value)


def split_multiselect(
    df: DataFrame, ids: Sequence[str], text: str, number: str = "option_no"
) -> DataFrame:
    """A list in text form ("1, 2, 3") to one row per number."""
    parts = F.split(F.col(text), r"\s*,\s*")
    return df.select(*ids, F.explode(parts).alias("_n")).select(
        *ids, F.trim("_n").try_cast("int").alias(number)
    ).filter(F.col(number).isNotNull())


def minus_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct left rows that the right side lacks."""
    return left.subtract(right)


def tagged_counts(frames: Mapping[str, DataFrame], tag: str = "side") -> DataFrame:
    one = {k: df.agg(F.count(F.lit(1)).alias("row_count")) for k, df in frames.items()}
    return concat_keyed(one, tag)


def lines_of(df: DataFrame, text: str, ids: Sequence[str] = (), line: str = "line") -> DataFrame:
    """One row per line of a text column."""
    return df.select(*ids, F.explode(F.split(F.col(text), "\n")).alias(line))


def field_of(line: Column, n: int) -> Column:
    """The n-th field of a line, fields parted by blanks or tabs; empty text if there is none."""
    parts = F.split(F.regexp_replace(line, r"^[ \t]+", ""), r"[ \t]+")
    return F.coalesce(F.get(parts, F.lit(n - 1)), F.lit(""))
