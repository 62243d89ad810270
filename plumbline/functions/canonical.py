"""One text form per value, so that row and key hashes are unambiguous.

Each value becomes ``<length>:<text>`` and a null becomes ``~``, so ``(a, null)`` and
``(null, a)``, or values that contain the separator, never collide.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Microseconds survive; the JSON writer's default keeps milliseconds only.
_JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def quoted(name: str) -> str:
    """A column name as an expression, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def free_name(base: str, *frames: DataFrame) -> str:
    """``base``, or ``base`` with underscores, that no column of the frames has."""
    taken = {c.lower() for df in frames for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def value_text(col: Column, dtype: T.DataType) -> Column:
    """Text of one value; equal values give equal text, null stays null."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return (col + F.lit(0).cast(dtype)).cast("string")  # -0.0 equals 0.0
    if isinstance(dtype, T.BinaryType):
        return F.hex(col)
    if isinstance(dtype, T.MapType):
        # Entry order carries no meaning in a map.
        return F.to_json(F.array_sort(F.map_entries(col)), _JSON_OPTIONS)
    if isinstance(dtype, (T.ArrayType, T.StructType)):
        return F.to_json(col, _JSON_OPTIONS)
    return col.cast("string")


def marked_text(col: Column, dtype: T.DataType) -> Column:
    text = value_text(col, dtype)
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~"))


def row_text(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """All columns of a row as one unambiguous text."""
    cols = list(cols or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    return F.concat(*[marked_text(F.col(quoted(c)), types[c]) for c in cols])


def row_hash_hex(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """SHA-256 of the row text as hex: for storing and for comparing across systems."""
    return F.sha2(row_text(df, cols), 256)


# The two columns of a row fingerprint.
FINGERPRINT = ("hash_a", "hash_b")


def _hash_cells(
    df: DataFrame, cols: Sequence[str], as_types: Mapping[str, T.DataType] | None
) -> list[Column]:
    """Arguments for a hash over rows: each value with a null flag.

    The hash functions pass over nulls, also inside nested values, so those go in as text.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cells: list[Column] = []
    for c in cols:
        col, dtype = F.col(quoted(c)), types[c]
        if as_types and as_types[c] != dtype:
            col, dtype = col.cast(as_types[c]), as_types[c]
        if isinstance(dtype, (T.DoubleType, T.FloatType)):
            col = col + F.lit(0).cast(dtype)
        elif isinstance(dtype, (T.MapType, T.ArrayType, T.StructType)):
            col = value_text(col, dtype)
        cells += [F.col(quoted(c)).isNull(), col]
    return cells


def row_fingerprint(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    as_types: Mapping[str, T.DataType] | None = None,
) -> list[Column]:
    """128 bits per row as two longs, from the values themselves instead of their text.

    Grouping on it shuffles 16 bytes per row. ``as_types`` names the types to hash in, where
    another table holds the same values in other types.
    """
    cells = _hash_cells(df, df.columns if cols is None else cols, as_types)
    return [F.xxhash64(F.lit(i), *cells).alias(name) for i, name in enumerate(FINGERPRINT)]


def row_mark(df: DataFrame) -> Column:
    """64 bits per row for placing rows; equal rows have equal marks."""
    return F.xxhash64(*_hash_cells(df, df.columns, None))
