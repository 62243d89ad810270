"""Scalar helpers, all native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trunc_seconds(ts: Column) -> Column:
    return F.date_trunc("SECOND", ts).cast("timestamp_ntz")


def epoch_to_date(seconds: Column) -> Column:
    """Epoch seconds to ``yyyy-MM-dd`` text in the session time zone."""
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd")


def next_fridays(day: Column, n: int) -> Column:
    """The next n Fridays as an array, the day itself included when it is one."""
    days = F.sequence(day, F.date_add(day, 7 * n - 1))
    return F.filter(days, lambda d: F.dayofweek(d) == 6)


def date_parts(day: Column) -> list[Column]:
    return [
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.weekofyear(day).alias("week"),
        F.dayofweek(day).alias("day_of_week"),
        F.dayofmonth(day).alias("day_of_month"),
    ]


def name_part(name: Column, index: int) -> Column:
    """Part of a dotted catalog name, counted from 1; negative counts from the end."""
    return F.split_part(name, F.lit("."), F.lit(index))


def text_to_list(text: Column) -> Column:
    """A JSON list in text form to array<string>; null when it is not one."""
    return F.from_json(text, "array<string>")


def matches(value: Column, pattern: Column, whole: bool = False) -> Column:
    """Regex match with the pattern in a column; an unknown result counts as no match."""
    if whole:
        pattern = F.concat(F.lit("^(?:"), pattern, F.lit(")$"))
    return F.coalesce(F.rlike(value, pattern), F.lit(False))


def zero_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def flag(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)


def exact_sum(col: Column, scale: int = 4) -> Column:
    """Sum of doubles as a decimal with ``scale`` decimals, exact to 18 decimals of each value.

    Unlike a sum of doubles it does not depend on the order of the rows. A value of at most four
    decimals is added as a whole number of their units; one with more decimals or very many digits
    is added as a longer decimal, which costs more and is rare. Only the sum is rounded.
    """
    units = F.rint(F.when(F.abs(col) < 9e11, col) * 1e4)  # below 2**53, where doubles hold them
    short = F.coalesce(units / 1e4 == col, F.lit(False))
    large = F.abs(col) >= 1e14
    kind, zero = f"decimal(38,{scale})", F.lit(0).cast("decimal(38,18)")
    few = F.sum(F.when(short, units.cast("long")).cast("decimal(18,0)")) * F.lit(1e-4).cast(
        "decimal(5,4)")
    deep = F.sum(F.when(~short & ~large, col.cast("decimal(38,18)")))
    whole = F.sum(F.when(large, col.cast("decimal(38,4)")))
    total = F.coalesce(few.cast("decimal(38,18)"), zero) + F.coalesce(
        deep.cast("decimal(38,18)"), zero)
    return F.when(whole.isNotNull(), (total.cast(kind) + whole).cast(kind)).when(
        F.count(col) > 0, total.cast(kind))
