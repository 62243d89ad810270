"""What to compare and how: the reconciliation options and the comparable form of a side."""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.canonical import quoted
from plumbline.functions.nested import sort_json_keys

CHECKS = ("schema", "counts", "hash", "dup_keys", "exclusive_keys", "cells")

DEFAULT_TYPE_EXPRS = {
    "timestamp": "date_trunc('SECOND', {col})",
    "timestamp_ntz": "cast(date_trunc('SECOND', {col}) AS timestamp_ntz)",
}


class SpecError(ValueError):
    """The options or the two tables do not fit together."""


def as_frame(spark: SparkSession, source: DataFrame | str) -> DataFrame:
    """A DataFrame as it is, or a catalog table by its name."""
    return spark.table(source) if isinstance(source, str) else source


@dataclass(frozen=True)
class ColumnInfo:
    name: str
    data_type: str
    position: int


@dataclass(frozen=True)
class TableSpec:
    """Column names (lower case), type names and positions of one table."""

    columns: tuple[ColumnInfo, ...]

    @classmethod
    def of(cls, source: DataFrame | T.StructType) -> TableSpec:
        schema = source.schema if isinstance(source, DataFrame) else source
        return cls(tuple(
            ColumnInfo(f.name.lower(), f.dataType.simpleString(), i)
            for i, f in enumerate(schema.fields)
        ))

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def type_of(self, name: str) -> str:
        return {c.name: c.data_type for c in self.columns}[name.lower()]


def _lower(names: Sequence[str]) -> tuple[str, ...]:
    return tuple(n.strip().lower() for n in names)


@dataclass(frozen=True)
class ReconSpec:
    """Options of one reconciliation.

    ``rename`` maps right-side names to left-side names. Expression templates hold ``{col}``
    where the column goes; they are trusted SQL text and apply to both sides, keyed by the
    left-side name.
    """

    keys: Sequence[str] = ()
    exclude: Sequence[str] = ()
    exclude_left: Sequence[str] = ()
    exclude_right: Sequence[str] = ()
    rename: Mapping[str, str] = field(default_factory=dict)
    column_exprs: Mapping[str, str] = field(default_factory=dict)
    type_exprs: Mapping[str, str] = field(default_factory=lambda: dict(DEFAULT_TYPE_EXPRS))
    sort_json: Sequence[str] = ()
    where: str = ""
    checks: Sequence[str] = CHECKS
    stop_on_failure: bool = False
    samples: int = 0
    include_plans: bool = False

    def __post_init__(self) -> None:
        for name in ("keys", "exclude", "exclude_left", "exclude_right", "sort_json", "checks"):
            value = getattr(self, name)
            if isinstance(value, str) or not all(isinstance(v, str) for v in value):
                raise SpecError(f"{name} must be a list of names")
            object.__setattr__(self, name, _lower(value))
        for name in ("rename", "column_exprs", "type_exprs"):
            value = getattr(self, name)
            if not isinstance(value, Mapping):
                raise SpecError(f"{name} must be a mapping")
            object.__setattr__(self, name, {k.lower(): v for k, v in value.items()})
        object.__setattr__(self, "rename", {k: v.lower() for k, v in self.rename.items()})
        if not isinstance(self.where, str):
            raise SpecError("where must be SQL text")
        for name in ("stop_on_failure", "include_plans"):
            if not isinstance(getattr(self, name), bool):
                raise SpecError(f"{name} must be true or false")
        if isinstance(self.samples, bool) or not isinstance(self.samples, int) or self.samples < 0:
            raise SpecError("samples must be a whole number, 0 for none")
        unknown = set(self.checks) - set(CHECKS)
        if unknown:
            raise SpecError(f"unknown checks: {sorted(unknown)}")
        repeated = [c for c in self.rename.values() if list(self.rename.values()).count(c) > 1]
        if repeated:
            raise SpecError(f"two right columns renamed to {sorted(set(repeated))}")

    @classmethod
    def from_options(cls, options: Mapping[str, object]) -> ReconSpec:
        """Build from a plain mapping; an unknown option is an error."""
        known = {f.name for f in dataclasses.fields(cls)}
        unknown = set(options) - known
        if unknown:
            raise SpecError(f"unknown options: {sorted(unknown)}")
        return cls(**options)

    def kept(self, df: DataFrame, side: str) -> list[str]:
        """Column names of a side that take part, as they are spelled there."""
        dropped = set(self.exclude)
        dropped |= set(self.exclude_left if side == "left" else self.exclude_right)
        return [c for c in df.columns if c.lower() not in dropped]

    def shared_name(self, name: str, side: str) -> str:
        return self.rename.get(name.lower(), name.lower()) if side == "right" else name.lower()


def prepare(df: DataFrame, spec: ReconSpec, side: str) -> DataFrame:
    """The comparable form of one side, as a lazy projection.

    The filter sees raw columns, so it reaches the scan. Then: drop the excluded columns,
    rename the right side to left-side names, apply the column expression, then the
    expression of the column's type.
    """
    if side not in ("left", "right"):
        raise SpecError("side is 'left' or 'right'")
    if spec.where:
        df = df.filter(F.expr(spec.where))
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out: list[Column] = []
    for name in spec.kept(df, side):
        shared = spec.shared_name(name, side)
        text = quoted(name)
        if shared in spec.column_exprs:
            text = spec.column_exprs[shared].replace("{col}", text)
        if types[name] in spec.type_exprs:
            text = spec.type_exprs[types[name]].replace("{col}", f"({text})")
        col = F.expr(text)
        if shared in spec.sort_json:
            col = sort_json_keys(col)
        out.append(col.alias(shared))
    return df.select(*out)


def precheck(left: DataFrame, right: DataFrame, spec: ReconSpec) -> None:
    """Both prepared sides hold the keys and the same column set, or ``SpecError``."""
    lcols, rcols = set(left.columns), set(right.columns)
    for side, cols in (("left", lcols), ("right", rcols)):
        missing = [k for k in spec.keys if k not in cols]
        if missing:
            raise SpecError(f"keys not on the {side} side: {missing}")
    if lcols != rcols:
        raise SpecError(
            f"columns only left: {sorted(lcols - rcols)}, only right: {sorted(rcols - lcols)}"
        )


def common_types(left: DataFrame, right: DataFrame) -> dict[str, T.DataType]:
    """The type in which each left column is compared with its right namesake.

    Two types that Spark would union meet in the common type; text against anything else, and
    types that do not meet, are compared as text. Hashes then agree whenever values do.
    """
    ltypes = {f.name: f.dataType for f in left.schema.fields}
    rtypes = {f.name: f.dataType for f in right.schema.fields}

    def common(name: str) -> T.DataType:
        lt, rt = ltypes[name], rtypes[name]
        if lt == rt:
            return lt
        if isinstance(lt, T.StringType) or isinstance(rt, T.StringType):
            return T.StringType()
        col = F.col(quoted(name))
        try:
            return left.select(col).union(right.select(col)).schema[0].dataType
        except AnalysisException:
            return T.StringType()

    return {name: common(name) for name in left.columns}


def cast_to(df: DataFrame, wanted: Mapping[str, T.DataType]) -> DataFrame:
    """The wanted columns in order, cast where their type differs."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[
        F.col(quoted(c)) if types[c] == t else F.col(quoted(c)).cast(t).alias(c)
        for c, t in wanted.items()
    ])
