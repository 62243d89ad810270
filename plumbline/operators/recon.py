"""The reconciliation checks. Each takes two prepared sides and returns a DataFrame.

Shape of the plans: everything that only counts (rows, repeated keys, keys on one side, row
hashes) is one union of both sides and one aggregation, so map-side partial sums shrink hot
keys before the shuffle and no join is needed. Only the cell comparison joins. It first finds
the differing keys from row fingerprints and then fetches the full rows of those keys alone. It
joins rows whose key is unique on at least one side, so its output grows linearly; keys repeated
on both sides are counted in closed form instead of being paired. With too many such keys to fetch
their rows, all pairs are counted in that form, from one shuffle of the rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from plumbline.functions.canonical import (
    FINGERPRINT, free_name, marked_text, quoted, row_fingerprint, value_text,
)
from plumbline.functions.sizing import broadcast_if_small, task_count
from plumbline.session import scratch
from plumbline.spec import TableSpec, cast_to, common_types

# Type pairs that count as the same, as full-match patterns (left, right).
TYPE_RULES = (
    ("bigint", r"decimal\(\d+,0\)"),
    ("int", r"decimal\(\d+,0\)"),
    ("double", r"decimal\(\d+,2\)"),
    ("timestamp_ntz", "timestamp"),
    (r"decimal\(\d+,2\)", r"decimal\(\d+,2\)"),
    (r"decimal\(\d+,0\)", r"decimal\(\d+,0\)"),
)


def columns(names: Sequence[str]) -> list[Column]:
    return [F.col(quoted(n)) for n in names]


def same_on(left: str, right: str, cols: Sequence[str]) -> Column:
    """Null-safe equality of the columns of two aliased frames."""
    cond = F.lit(True)
    for i, c in enumerate(cols):
        eq = F.col(f"{left}.{quoted(c)}").eqNullSafe(F.col(f"{right}.{quoted(c)}"))
        cond = eq if i == 0 else cond & eq
    return cond


def any_diff(left: str, right: str, cols: Sequence[str]) -> Column:
    cond = F.lit(False)
    for i, c in enumerate(cols):
        ne = ~F.col(f"{left}.{quoted(c)}").eqNullSafe(F.col(f"{right}.{quoted(c)}"))
        cond = ne if i == 0 else cond | ne
    return cond


# --- schema ---------------------------------------------------------------------------

def schema_pairs(
    spark: SparkSession, left: T.StructType, right: T.StructType
) -> DataFrame:
    """Columns of two schemas side by side by name; a one-sided column keeps a null type."""
    def rows(schema: T.StructType, kind: str) -> DataFrame:
        data = [(c.name, c.data_type) for c in TableSpec.of(schema).columns]
        return spark.createDataFrame(data, f"col_name string, {kind} string")

    return rows(left, "left_type").join(rows(right, "right_type"), "col_name", "full_outer")


def schema_rows(
    left: T.StructType, right: T.StructType, rules: Sequence[tuple[str, str]] = TYPE_RULES
) -> list[tuple[str, str | None, str | None, bool]]:
    """(name, left type, right type, matched) of every column of either side.

    Types match when they are equal or one rule covers the pair. Schemas are driver objects,
    so no job runs.
    """
    lt = {c.name: c.data_type for c in TableSpec.of(left).columns}
    rt = {c.name: c.data_type for c in TableSpec.of(right).columns}

    def matched(a: str | None, b: str | None) -> bool:
        if a is None or b is None:
            return False
        return a == b or any(re.fullmatch(x, a) and re.fullmatch(y, b) for x, y in rules)

    return [(n, lt.get(n), rt.get(n), matched(lt.get(n), rt.get(n))) for n in {**lt, **rt}]


def check_schema(
    spark: SparkSession,
    left: T.StructType,
    right: T.StructType,
    rules: Sequence[tuple[str, str]] = TYPE_RULES,
) -> DataFrame:
    """:func:`schema_rows` as (col_name, left_type, right_type, matched)."""
    return spark.createDataFrame(
        schema_rows(left, right, rules),
        "col_name string, left_type string, right_type string, matched boolean",
    )


# --- counts and keys ------------------------------------------------------------------

def _tagged(df: DataFrame, cols: Sequence[str], side: str) -> DataFrame:
    return df.select(
        *[F.col(quoted(c)) for c in cols],
        F.lit(int(side == "left")).cast("long").alias("n_left"),
        F.lit(int(side == "right")).cast("long").alias("n_right"),
    )


def key_census(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key value: rows on the left and on the right. One shuffle, partial sums first.

    Grouping treats null keys as equal, as the null-safe join does.
    """
    both = _tagged(left, keys, "left").unionByName(_tagged(right, keys, "right"))
    return both.groupBy(*[F.col(quoted(k)) for k in keys]).agg(
        F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right")
    )


def _sum_if(cond: Column, value: Column) -> Column:
    return F.coalesce(F.sum(F.when(cond, value)), F.lit(0)).cast("long")


def _total_columns() -> list[Column]:
    """Row counts, repeated keys and one-sided rows of both sides, over a census."""
    nl, nr, one = F.col("n_left"), F.col("n_right"), F.lit(1)
    return [
        _sum_if(F.lit(True), nl).alias("rows_left"),
        _sum_if(F.lit(True), nr).alias("rows_right"),
        _sum_if(nl > 1, one).alias("dup_left"),
        _sum_if(nr > 1, one).alias("dup_right"),
        _sum_if(nr == 0, nl).alias("only_left"),
        _sum_if(nl == 0, nr).alias("only_right"),
        _sum_if((nl > 1) & (nr > 1), one).alias("repeated_both"),
    ]


def _hash_columns(equal: Column, single: Column) -> list[Column]:
    """Row-hash differences over a key census: a key whose rows are all equal is one distinct row, and
    two unequal rows, one of each side, are two. The other keys are ``tangled``."""
    nl, nr, one = F.col("n_left"), F.col("n_right"), F.lit(1)
    pair = ~equal & single
    return [
        _sum_if((equal & (nr == 0)) | pair, one).alias("row_diff"),
        _sum_if((equal & (nl == 0)) | pair, one).alias("only_right_rows"),
        _sum_if(equal & (nl > 0) & (nr > 0) & (nl != nr), one).alias("copies_differ"),
        _sum_if(~equal & ~single, one).alias("tangled"),
    ]


def census_totals(census: DataFrame) -> DataFrame:
    """The totals of a census as one row."""
    return census.agg(*_total_columns())


def check_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """(side, row_count): no shuffle beyond the final partial counts."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("side"), "row_count"
        )

    return side(left, "left").unionByName(side(right, "right"))


def _by_side(totals: DataFrame, left: str, right: str, value: str) -> DataFrame:
    """One row of totals to one row per side."""
    pairs = F.array(
        F.struct(F.lit("left").alias("side"), F.col(left).alias(value)),
        F.struct(F.lit("right").alias("side"), F.col(right).alias(value)),
    )
    return totals.select(F.inline(pairs))


def check_dup_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(side, dup_keys): key values held by more than one row; 0 where there are none."""
    return _by_side(census_totals(key_census(left, right, keys)), "dup_left", "dup_right",
                    "dup_keys")


def check_exclusive_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(side, exclusive_rows): rows without a partner on the other side, null-safe."""
    return _by_side(census_totals(key_census(left, right, keys)), "only_left", "only_right",
                    "exclusive_rows")


# --- row hashes -----------------------------------------------------------------------

def hash_census(left: DataFrame, right: DataFrame) -> DataFrame:
    """Per row fingerprint: copies on the left and on the right. Columns are matched by name."""
    types = common_types(left, right)
    lh = left.select(*row_fingerprint(left, left.columns, types))
    rh = right.select(*row_fingerprint(right, left.columns, types))
    return key_census(lh, rh, FINGERPRINT)


def check_hash(left: DataFrame, right: DataFrame) -> DataFrame:
    """Row-hash differences in both directions and in the number of copies.

    ``row_diff`` is the number of distinct left rows absent on the right; ``only_right`` is
    the other direction; ``copies_differ`` counts rows both sides hold, but not equally often.
    """
    nl, nr, one = F.col("n_left"), F.col("n_right"), F.lit(1)
    return hash_census(left, right).agg(
        _sum_if(nr == 0, one).alias("row_diff"),
        _sum_if(nl == 0, one).alias("only_right"),
        _sum_if((nl > 0) & (nr > 0) & (nl != nr), one).alias("copies_differ"),
    )


def unmatched_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left rows whose fingerprint is in the left-minus-right set; all their copies stay."""
    missing = hash_census(left, right).filter("n_right = 0").select(*FINGERPRINT)
    prints = row_fingerprint(left, left.columns, common_types(left, right))
    return with_keys(left.select("*", *prints), missing, FINGERPRINT, "left_semi").select(
        *columns(left.columns)
    )


def sample_unmatched(left: DataFrame, right: DataFrame, n: int) -> DataFrame:
    """The first n unmatched left rows in column order (a stable choice of samples)."""
    return unmatched_rows(left, right).orderBy(*columns(left.columns)).limit(n)


# --- cells ----------------------------------------------------------------------------


def with_keys(df: DataFrame, found: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on null-safe keys.

    The hash in the condition gives this join a partitioning of its own. A later join on the
    keys then reads its sides straight from a shuffle, which is what adaptive execution needs
    to split a hot key.
    """
    name = free_name("_h", df, found)
    own = [F.col(quoted(k)) for k in keys]
    mark = F.xxhash64(*own).alias(name)
    lhs, rhs = df.select("*", mark).alias("d"), found.select(*own, mark).alias("f")
    cond = (F.col(f"d.{name}") == F.col(f"f.{name}")) & same_on("d", "f", keys)
    return lhs.join(rhs, cond, how).drop(name)


@dataclass(frozen=True)
class KeyFindings:
    """What one pass over the keys and row fingerprints of both sides found.

    ``marked`` holds (keys, n_left, n_right, differs, tangled) of the keys that differ, repeat on
    both sides, or have several unequal rows. It is a written table, so its size is known to the
    joins that use it and nothing is computed twice. ``hot`` holds the keys of over ``HOT_ROWS`` rows.
    """

    totals: dict[str, int]
    marked: DataFrame
    hot: DataFrame
    keys: tuple[str, ...]
    scan: DataFrame | None = None  # the pass itself, for its plan

    @property
    def differing(self) -> DataFrame:
        """Keys, unique on at least one side, whose rows are not all equal."""
        return self.marked.filter("differs AND NOT (n_left > 1 AND n_right > 1)").select(
            *columns(self.keys))

    @property
    def repeated(self) -> DataFrame:
        """Keys held by several rows on both sides."""
        return self.marked.filter("n_left > 1 AND n_right > 1").select(
            *columns(self.keys))

    @property
    def tangled(self) -> DataFrame:
        """Keys of several rows that are not all equal: their rows have to be looked at."""
        return self.marked.filter("tangled").select(*columns(self.keys))


# A key of more rows than this, of both sides together, is too much for one task.
HOT_ROWS = 10_000


def _product(a: Column, b: Column) -> Column:
    wide = T.DecimalType(19, 0)
    return (a.cast(wide) * b.cast(wide)).cast(T.DecimalType(38, 0))


def scan_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> KeyFindings:
    """One job over (keys, row fingerprint) of both sides.

    It shuffles the keys and 16 bytes per row, after partial aggregation. The totals are
    observed while the few keys of interest are written to the shared folder.
    """
    rest = [c for c in left.columns if c not in keys]
    types = common_types(left, right)
    left, right = cast_to(left, types), cast_to(right, types)

    def side(df: DataFrame, name: str) -> DataFrame:
        counts = [F.lit(int(name == s)).cast("long").alias(f"n_{s}") for s in ("left", "right")]
        return df.select(*columns(keys), *row_fingerprint(df, rest), *counts)

    both = side(left, "left").unionByName(side(right, "right"))
    # Both halves side by side: for a single row the compressor sees the same 16 bytes twice.
    bounds = [f(h).alias(f"{n}_{h}") for n, f in (("lo", F.min), ("hi", F.max))
              for h in FINGERPRINT]
    census = both.groupBy(*columns(keys)).agg(
        F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"), *bounds
    )
    matched = (F.col("n_left") > 0) & (F.col("n_right") > 0)
    unequal = F.lit(False)
    for h in FINGERPRINT:
        unequal = unequal | (F.col(f"lo_{h}") != F.col(f"hi_{h}"))
    each = (F.col("n_left") <= 1) & (F.col("n_right") <= 1)
    flagged = census.select(*columns(keys), "n_left", "n_right", (matched & unequal).alias("differs"),
                            (unequal & ~each).alias("tangled"), unequal.alias("unequal"))
    seen = Observation()
    nl, nr = F.col("n_left"), F.col("n_right")
    wanted = F.expr("differs OR tangled OR (n_left > 1 AND n_right > 1)")
    repeated, hot = (nl > 1) & (nr > 1), nl + nr > HOT_ROWS
    pairs = lambda cond: F.coalesce(
        F.sum(F.when(cond, _product(nl, nr))), F.lit(0)).cast(T.DecimalType(38, 0))
    observed = flagged.observe(
        seen, *_total_columns(), *_hash_columns(~F.col("unequal"), each),
        _sum_if(F.col("differs") & ~repeated, F.lit(1)).alias("differing"),
        _sum_if(wanted, F.lit(1)).alias("marked"), _sum_if(hot, F.lit(1)).alias("hot"),
        _sum_if(repeated, nl + nr).alias("rows_repeated"),
        pairs(repeated).alias("pairs_repeated"), pairs(matched).alias("pairs"))
    path = scratch(left.sparkSession, "keys")
    flagged = flagged.drop("unequal")
    observed.filter(wanted | hot).drop("unequal").write.parquet(path)
    written = left.sparkSession.read.schema(flagged.schema).parquet(path)
    return KeyFindings(dict(seen.get), written.filter(wanted),
                       written.filter(hot).select(*columns(keys)), tuple(keys), flagged)


# Up to this many differing keys the full rows are fetched by key, not shuffled.
FEW_KEYS = 1_000_000


def fetch(left: DataFrame, right: DataFrame, found: KeyFindings) -> tuple[DataFrame, DataFrame]:
    """The rows of marked keys of both sides, written once for all checks that look at them.

    With very many marked keys the sides come back as they are: the checks then read them.
    """
    n = found.totals["marked"]
    if n > FEW_KEYS:
        return left, right
    types, spark = common_types(left, right), left.sparkSession
    few = broadcast_if_small(found.marked.select(*columns(found.keys)), FEW_KEYS, known_rows=n)

    def kept(df: DataFrame) -> DataFrame:
        path = scratch(spark, "rows")
        rows = with_keys(cast_to(df, types), few, found.keys, "left_semi") if n else df.limit(0)
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    return kept(left), kept(right)


def hash_differences(left: DataFrame, right: DataFrame, found: KeyFindings) -> dict[str, int]:
    """The totals of :func:`check_hash` from the key scan, and from the rows of tangled keys."""
    totals = {"row_diff": found.totals["row_diff"], "only_right": found.totals["only_right_rows"],
              "copies_differ": found.totals["copies_differ"]}
    if found.totals["tangled"]:
        lt, rt = (with_keys(df, found.tangled, found.keys, "left_semi") for df in (left, right))
        more = check_hash(lt, rt).first().asDict()
        totals = {k: v + more[k] for k, v in totals.items()}
    return totals


def cell_diff(
    left: DataFrame, right: DataFrame, keys: Sequence[str], found: KeyFindings | None = None
) -> DataFrame:
    """Matched rows that differ in a non-key column.

    Columns: the keys, then per compared column ``<c>_left``, ``<c>_right``, ``<c>_diff``.
    Keys repeated on both sides are left to :func:`repeated_key_values`, so no key pairs
    more rows than it holds.

    With few differing keys, as is usual, the key list goes to every task and only its rows
    are shuffled. Otherwise the two sides are joined as they are.
    """
    cols = [c for c in left.columns if c not in keys]
    found = found or scan_keys(left, right, keys)
    types = common_types(left, right)
    left, right = cast_to(left, types), cast_to(right, types)
    if found.totals["differing"] <= FEW_KEYS:
        few = broadcast_if_small(found.differing, FEW_KEYS, known_rows=found.totals["differing"])
        left, right = (with_keys(df, few, keys, "left_semi") for df in (left, right))
    elif found.totals["repeated_both"]:
        left = with_keys(left, found.repeated, keys, "left_anti")
    lhs, rhs = left.alias("l"), right.alias("r")
    cond = same_on("l", "r", keys) & any_diff("l", "r", cols)
    if not found.totals["differing"]:
        cond = F.lit(False)  # known to be empty: the plan then reads nothing
    out = [F.col(f"l.{quoted(k)}").alias(k) for k in keys]
    for c in cols:
        lc, rc = F.col(f"l.{quoted(c)}"), F.col(f"r.{quoted(c)}")
        out += [lc.alias(f"{c}_left"), rc.alias(f"{c}_right"),
                (~lc.eqNullSafe(rc)).alias(f"{c}_diff")]
    return lhs.join(rhs, cond, "inner").select(*out)


def _values_of(
    df: DataFrame, repeated: DataFrame, keys: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """(keys, col_name, value): one row per cell of the rows with a repeated key."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("col_name"),
            value_text(F.col(quoted(c)), types[c]).alias("value"),
        )
        for c in cols
    ])
    rows = with_keys(df, repeated, keys, "left_semi")
    return rows.select(*columns(keys), F.inline(cells))


def repeated_key_values(
    left: DataFrame, right: DataFrame, keys: Sequence[str], found: KeyFindings | None = None
) -> DataFrame:
    """For keys repeated on both sides: (keys, col_name, value, n_left, n_right).

    This is the whole content of those key groups in counted form; it grows with the number
    of cells, not with the number of row pairs.
    """
    cols = [c for c in left.columns if c not in keys]
    found = found or scan_keys(left, right, keys)
    types = common_types(left, right)
    lv = _values_of(cast_to(left, types), found.repeated, keys, cols)
    rv = _values_of(cast_to(right, types), found.repeated, keys, cols)
    return key_census(lv, rv, [*keys, "col_name", "value"])


# Cells, of both sides together, that one task counts: their hashes stay in its memory.
TASK_CELLS = 1_500_000
# More rows than this are shuffled in so many passes, each with its share of the keys, so that what
# a task sorts for the shuffle stays in its memory too. Their number does not grow with the input.
PASS_ROWS, PASSES = 20_000_000, 4


def _fits_a_long(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.DecimalType):
        return dtype.precision <= 18
    return isinstance(dtype, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType,
                              T.TimestampNTZType))


def _nests_floats(dtype: T.DataType) -> bool:
    """Whether equal values may have unlike hashes: -0.0 and 0.0 inside a nested value."""
    nested = isinstance(dtype, (T.ArrayType, T.MapType, T.StructType))
    return nested and any(f'"{t}"' in dtype.json() for t in ("double", "float"))


def _repeated_pair_counts(
    left: DataFrame, right: DataFrame, keys: Sequence[str], found: KeyFindings, every: bool = False
) -> DataFrame:
    """(col_name, mismatch_cnt): differing row pairs of keys repeated on both sides, or of every key,
    as all pairs less equal pairs.

    The key scan knows the number of pairs. For the equal ones each row is shuffled once, by its
    keys: a short value as it is, any other as 128 bits of hash. The task that gets a key counts its
    equal values by hash, and there are so many tasks that these stay in memory. Hot keys go
    another way, in which every step is a partial aggregate: equal rows become one row with two
    counts, then equal values of a key and column do, so neither a hot key nor a hot row meets in one
    task unreduced.
    """
    cols = [c for c in left.columns if c not in keys]
    types, totals = common_types(left, right), found.totals
    key = [f"k{i}" for i in range(len(keys))]
    short = [_fits_a_long(types[c]) for c in cols]
    left, right = cast_to(left, types), cast_to(right, types)
    if not every:
        few = broadcast_if_small(found.repeated, FEW_KEYS, known_rows=totals["repeated_both"])
        # Rows are picked before their cells are hashed: a join that is not broadcast then
        # shuffles the plain row, not a 16-byte fingerprint of every column.
        left, right = (with_keys(df, few, keys, "left_semi") for df in (left, right))

    def side(df: DataFrame, name: str) -> DataFrame:
        out = [F.col(quoted(k)).alias(a) for k, a in zip(keys, key, strict=True)]
        for i, c in enumerate(cols):
            if short[i]:
                out.append(F.col(quoted(c)).alias(f"v{i}"))
            else:
                out += [h.alias(f"{n}{i}") for n, h in zip("ab", row_fingerprint(df, [c]))]
        return df.select(*out, *[F.lit(int(name == s)).cast("long").alias(f"n_{s}")
                                 for s in ("left", "right")])

    def rows(how: str | None = None) -> DataFrame:
        lhs, rhs = left, right
        if how:
            hot = broadcast_if_small(found.hot, FEW_KEYS, known_rows=totals["hot"])
            lhs, rhs = (with_keys(df, hot, keys, how) for df in (left, right))
        return side(lhs, "left").unionByName(side(rhs, "right"))

    both = [F.sum(n).alias(n) for n in ("n_left", "n_right")]

    def same(df: DataFrame) -> DataFrame:
        """(at, same): pairs of equal values by the place of their column."""
        cells = F.array(*[
            F.struct(F.lit(i).alias("at"),
                     *(row_fingerprint(df, [f"v{i}"]) if short[i] else
                       [F.col(f"{n}{i}").alias(h) for n, h in zip("ab", FINGERPRINT)]))
            for i in range(len(cols))])
        values = df.select(*key, F.inline(cells), "n_left", "n_right").groupBy(
            *key, "at", *FINGERPRINT).agg(*both)
        nl, nr = F.col("n_left"), F.col("n_right")
        return values.groupBy("at").agg(
            F.sum(F.when((nl > 0) & (nr > 0), _product(nl, nr))).alias("same"))

    n_rows = totals["rows_left"] + totals["rows_right"] if every else totals["rows_repeated"]
    tasks = max(task_count(left.sparkSession), -(-n_rows * len(cols) // TASK_CELLS))
    cold, passes = rows("left_anti" if totals["hot"] else None), PASSES if n_rows > PASS_ROWS else 1
    shares = [cold] if passes == 1 else [
        cold.filter(F.pmod(F.xxhash64(*key), F.lit(passes)) == i) for i in range(passes)]
    equal = reduce(DataFrame.unionByName, [
        same(share.repartition(-(-tasks // passes), *key)) for share in shares])
    if totals["hot"]:
        hot = rows("left_semi")
        equal = equal.unionByName(same(hot.groupBy(*hot.drop("n_left", "n_right").columns).agg(*both)))
    names = F.array(*[F.lit(c) for c in cols])
    pairs = F.lit(totals["pairs" if every else "pairs_repeated"]).cast(T.DecimalType(38, 0))
    differ = pairs - F.coalesce(F.sum("same"), F.lit(0))
    return equal.groupBy("at").agg(differ.cast("long").alias("mismatch_cnt")).select(
        F.get(names, F.col("at")).alias("col_name"), "mismatch_cnt")


def diff_counts_of(diffs: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(col_name, mismatch_cnt) from a cell difference frame: one row of sums, unpivoted."""
    sums = diffs.agg(*[
        F.coalesce(F.sum(F.col(quoted(c + "_diff")).cast("long")), F.lit(0)).alias(c) for c in cols
    ])
    return sums.unpivot([], [F.col(quoted(c)) for c in cols], "col_name", "mismatch_cnt")


def check_cells(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    found: KeyFindings | None = None,
    diffs: DataFrame | None = None,
) -> DataFrame:
    """(col_name, mismatch_cnt): row pairs with the same key that differ in the column.

    Only columns with differences are listed. Pairs of keys repeated on both sides are
    counted without being formed. Each side is read twice at most: for the key scan, and for the
    rows of the keys that it marks. Where these are too many to fetch, all pairs are counted in that
    way: each side is then read once a pass, and once more for hot keys, if there are any.
    """
    cols = [c for c in left.columns if c not in keys]
    if not cols:
        return left.sparkSession.createDataFrame([], "col_name string, mismatch_cnt long")
    if found is None:
        found = scan_keys(left, right, keys)
        left, right = fetch(left, right, found)
    if found.totals["marked"] > FEW_KEYS and not any(
            _nests_floats(t) for c, t in common_types(left, right).items() if c in cols):
        return _repeated_pair_counts(left, right, keys, found, every=True).filter("mismatch_cnt > 0")
    counts = diff_counts_of(cell_diff(left, right, keys, found) if diffs is None else diffs, cols)
    if found.totals["repeated_both"]:
        more = _repeated_pair_counts(left, right, keys, found)
        counts = counts.unionByName(more).groupBy("col_name").agg(
            F.sum("mismatch_cnt").alias("mismatch_cnt"))
    return counts.filter("mismatch_cnt > 0")


def _first_per(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """First n rows per group; Spark cuts each partition to n before the shuffle."""
    place = free_name("_n", df)
    w = Window.partitionBy(*[F.col(quoted(c)) for c in by]).orderBy(
        *[F.col(quoted(c)) for c in order])
    return df.withColumn(place, F.row_number().over(w)).filter(F.col(place) <= n).drop(place)


def _first_distinct(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """First n distinct rows per group, in the order of all other columns.

    Equal rows have one rank, so Spark cuts each task to n ranks per group before the shuffle.
    """
    place = free_name("_n", df)
    w = Window.partitionBy(*columns(by)).orderBy(*columns(order))
    return df.withColumn(place, F.dense_rank().over(w)).filter(F.col(place) <= n).drop(
        place).distinct()


def diff_samples(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    n: int,
    found: KeyFindings | None = None,
    diffs: DataFrame | None = None,
) -> DataFrame:
    """Up to n distinct (keys, col_name, left_val, right_val) per differing column.

    The choice is stable: the first n in key and value order. For keys repeated on both sides
    the n + 1 smallest distinct values of each side are enough to find the first n pairs.
    """
    cols = [c for c in left.columns if c not in keys]
    types = common_types(left, right)
    if found is None:
        found = scan_keys(left, right, keys)
        left, right = fetch(left, right, found)
    if diffs is None:
        diffs = cell_diff(left, right, keys, found)
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("col_name"),
            value_text(F.col(quoted(c + "_left")), types[c]).alias("left_val"),
            value_text(F.col(quoted(c + "_right")), types[c]).alias("right_val"),
            F.col(quoted(c + "_diff")).alias("differs"),
        )
        for c in cols
    ])
    picked = diffs.select(*columns(keys), F.inline(cells)).filter("differs").drop("differs")
    order = [*keys, "left_val", "right_val"]
    if not found.totals["repeated_both"]:
        return _first_distinct(picked, ["col_name"], order, n)
    values = repeated_key_values(left, right, keys, found)
    group = [*keys, "col_name"]
    lv = _first_per(values.filter("n_left > 0"), group, ["value"], n + 1)
    rv = _first_per(values.filter("n_right > 0"), group, ["value"], n + 1)
    lv = lv.select(*group, F.col("value").alias("left_val")).alias("l")
    rv = rv.select(*group, F.col("value").alias("right_val")).alias("r")
    cond = same_on("l", "r", group) & ~F.col("left_val").eqNullSafe(F.col("right_val"))
    multi = lv.join(rv, cond).select(
        *[F.col(f"l.{quoted(c)}").alias(c) for c in group], "left_val", "right_val"
    )
    return _first_distinct(picked.unionByName(multi), ["col_name"], order, n)


def key_text(df: DataFrame, keys: Sequence[str]) -> Column:
    """The key columns as one unambiguous text."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return F.concat(*[marked_text(F.col(quoted(k)), types[k]) for k in keys])
