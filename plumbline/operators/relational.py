"""Small reusable projections, joins, aggregations and top-n forms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.functions.canonical import free_name, quoted, row_mark
from plumbline.functions.sizing import broadcast_if_small  # noqa: F401
from plumbline.operators.recon import same_on, with_keys
from plumbline.session import scratch

# --- projections ----------------------------------------------------------------------

def apply_mapping(df: DataFrame, mapping: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Retype and rename: rows of (source column, target column, target type).

    A value that does not fit becomes null instead of failing the job.
    """
    return df.select(*[F.col(quoted(s)).try_cast(t).alias(n) for s, n, t in mapping])


def retype(df: DataFrame, manifest: Sequence[tuple[int, str, str]]) -> DataFrame:
    """All-text rows to typed columns by a (position, name, type) manifest."""
    ordered = sorted(manifest)
    return df.select(*[
        F.col(quoted(df.columns[pos])).try_cast(dtype).alias(name) for pos, name, dtype in ordered
    ])


def pick_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The first columns under new names."""
    return df.select(*[F.col(quoted(c)) for c in df.columns[: len(names)]]).toDF(*names)


# --- joins ----------------------------------------------------------------------------

def hot_keys(df: DataFrame, key: str, share: float) -> list:
    """Key values (None for null) holding more than ``share`` of the rows.

    There are at most 1 / share of them, so the list on the driver is bounded.
    """
    counts = df.groupBy(F.col(quoted(key)).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    total = df.count()
    return [r[0] for r in counts.filter(F.col("n") > F.lit(share * total)).select("k").collect()]


def is_hot(key: str, hot: list) -> Column:
    """True for the rows of a hot key, never null."""
    values = [v for v in hot if v is not None]
    col = F.col(quoted(key))
    cond = F.coalesce(col.isin(values), F.lit(False)) if values else F.lit(False)
    return cond | col.isNull() if None in hot else cond


def salted(df: DataFrame, key: str, hot: list, salts: int, name: str = "salt") -> DataFrame:
    """Add a salt column: spread over ``salts`` values for hot keys, 0 for the others.

    ``name`` must not be a column of the frame; ``free_name`` finds one that is not.

    The salt comes from the row itself, so a task that runs again after a lost executor puts
    every row where it was. Only rows with very many exact copies (at most ``salts`` distinct
    ones) are placed at random, and copies may change places.
    """
    if name in df.columns:
        raise ValueError(f"the frame has a column {name}")
    if not hot:
        return df.withColumn(name, F.lit(0))
    mark = row_mark(df)
    marks = df.filter(is_hot(key, hot)).select(mark.alias("m"))
    copies = marks.groupBy("m").agg(F.count(F.lit(1)).alias("n"))
    many = copies.filter(F.col("n") > F.lit(marks.count() / salts)).select("m").collect()
    at_random = mark.isin([r.m for r in many]) if many else F.lit(False)
    spread = F.when(at_random, (F.rand(17) * salts).cast("int")).otherwise(
        F.pmod(mark, F.lit(salts)).cast("int"))
    return df.withColumn(name, F.when(is_hot(key, hot), spread).otherwise(0))


def salted_join(
    big: DataFrame, other: DataFrame, key: str, hot: list, salts: int = 32, how: str = "inner"
) -> DataFrame:
    """Equi-join where the rows of hot keys of ``big`` are spread over several tasks.

    The other side's rows of the hot keys are repeated once per salt. Valid for inner joins
    and for left joins from ``big``.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join keeps the rows of the big side: inner or left")
    only_zero = F.array(F.lit(0))
    all_salts = F.sequence(F.lit(0), F.lit(salts - 1))
    copies = F.when(is_hot(key, hot), all_salts).otherwise(only_zero) if hot else only_zero
    name = free_name("salt", big, other)
    right = other.withColumn(name, F.explode(copies))
    return salted(big, key, hot, salts, name).join(right, [key, name], how).drop(name)


def sort_spread(df: DataFrame, *cols: str | Column) -> DataFrame:
    """A total sort in which rows that tie on all columns still spread over several tasks.

    Sort partitions are ranges of the sort key, and one repeated key cannot be cut. Ties go by
    a mark of the whole row, and only exact copies by chance.
    """
    mark, tie = free_name("_mark", df), free_name("_tie", df)
    ties = df.withColumns({mark: row_mark(df), tie: F.rand(11)})
    keys = [F.col(quoted(c)) if isinstance(c, str) else c for c in cols]
    return ties.orderBy(*keys, mark, tie).drop(mark, tie)


def range_spread(df: DataFrame, *cols: str, n: int | None = None) -> DataFrame:
    """Range partitions by the columns; rows that tie on them spread as in :func:`sort_spread`."""
    keys = [*[F.col(quoted(c)) for c in cols], row_mark(df), F.rand(13)]
    return df.repartitionByRange(n, *keys) if n else df.repartitionByRange(*keys)


def anti_nullsafe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows without a partner; null keys match null keys."""
    return left.alias("l").join(right.alias("r"), same_on("l", "r", keys), "left_anti")


def zero_filled_counts(df: DataFrame, by: str, groups: DataFrame) -> DataFrame:
    """(by, row_count) for every wanted group, 0 where there are no rows.

    Rows are counted before the join, so it joins one row per group. The count is ``row_count_`` where
    the key has that name.
    """
    key, n = F.col(quoted(by)), "row_count"
    counts = df.groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("n")).alias("c")
    if by.lower() == n:
        n = free_name(n, groups.select(key))
    joined = groups.select(key.alias("k")).alias("g").join(
        counts, F.col("g.k") == F.col("c.k"), "left")
    return joined.select(F.col("g.k").alias(by), F.coalesce("c.n", F.lit(0)).cast("long").alias(n))


# --- aggregations ---------------------------------------------------------------------

def dup_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their count."""
    out = free_name("copies", df.select(*[F.col(quoted(k)) for k in keys]))
    groups = df.groupBy(*[F.col(quoted(k)) for k in keys]).agg(F.count(F.lit(1)).alias(out))
    return groups.filter(F.col(out) > 1)


def latest_per_key(
    df: DataFrame, key: str, order: Sequence[str], value: str, keys: DataFrame | None = None
) -> DataFrame:
    """The last value per key; keys of the list without rows stay, with null.

    ``max_by`` is a partial aggregate, so a hot key is reduced before the shuffle.
    """
    newest = F.struct(*[F.col(quoted(c)) for c in order])
    last = df.groupBy(F.col(quoted(key)).alias("k")).agg(
        F.max_by(F.col(quoted(value)), newest).alias("v"))
    if keys is None:
        return last.select(F.col("k").alias(key), F.col("v").alias(value))
    own = keys.select(F.col(quoted(key)).alias("k"), F.struct(*[
        F.col(quoted(c)) for c in keys.columns if c != key] or [F.lit(None)]).alias("rest")).alias("o")
    rest = [F.col(f"o.rest.{quoted(c)}").alias(c) for c in keys.columns if c != key]
    return own.join(last.alias("t"), F.col("o.k") == F.col("t.k"), "left").select(
        F.col("o.k").alias(key), *rest, F.col("t.v").alias(value))


def latest_row(
    df: DataFrame, key: str, order: Sequence[str], defaults: Mapping[str, Column]
) -> DataFrame:
    """The last row's fields per key, each with a default where the field is missing."""
    cols = [F.col(quoted(c)) for c in defaults]
    newest = F.struct(*[F.col(quoted(c)) for c in order])
    last = df.groupBy(F.col(quoted(key)).alias("k")).agg(
        F.max_by(F.struct(*cols), newest).alias("r"))
    return last.select(F.col("k").alias(key), *[F.coalesce(F.col(f"r.{quoted(c)}"), d).alias(c)
                                                for c, d in defaults.items()])


def ordered_concat(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    text: Column,
    sep: str,
    out: str = "text",
    max_pieces: int = 100_000,
) -> DataFrame:
    """Text pieces per key joined in order, as (by, part, out); ties go in text order.

    Part k holds pieces k * ``max_pieces`` up to the next multiple, so a key with fewer gives one
    row, part 0, and the parts of a longer one, read in order, make up the whole. The rule is the
    same for all keys and the same in every run. Pieces of long keys are sorted over all tasks, so
    no task holds more than ``max_pieces`` of one key.
    """
    if clash := {"part", out} & set(by):
        raise ValueError(f"the result has columns of its own named {sorted(clash)}")
    pieces = df.select(*by, F.struct(*order, text.alias("_t")).alias("_p"))
    counts = pieces.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    long_keys = counts.filter(F.col("n") > max_pieces).select(*by)

    def joined(rows: DataFrame, part: Column) -> DataFrame:
        lists = rows.withColumn("part", part).groupBy(*by, "part").agg(
            F.array_sort(F.collect_list("_p")).alias("_l"))
        return lists.select(
            *by, "part", F.array_join(F.transform("_l", lambda p: p["_t"]), sep).alias(out))

    first = F.lit(0).cast("long")
    if long_keys.isEmpty():
        return joined(pieces, first)
    short = with_keys(pieces, long_keys, by, "left_anti")
    rest = with_keys(pieces, long_keys, by, "left_semi")
    # The ranges of a sort may differ between runs, so the sorted rows are written once; the place
    # of a piece is its row within the file part, after the pieces of its key in earlier parts.
    spark, path = df.sparkSession, scratch(df.sparkSession, "pieces")
    sort_spread(rest, *by, "_p").withColumns({
        "_task": F.spark_partition_id(), "_id": F.monotonically_increasing_id()}
    ).write.parquet(path)
    placed = spark.read.parquet(path)
    runs = placed.groupBy(*by, "_task").agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*by).orderBy("_task").rowsBetween(
        Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    found = placed.alias("l").join(runs.alias("r"), same_on("l", "r", [*by, "_task"])).select(
        *[F.col(f"l.{quoted(c)}").alias(c) for c in by], "_p",
        (F.col("_id") - F.col("_first") + F.col("_before")).alias("_at"))
    cut = F.floor(F.col("_at") / F.lit(max_pieces)).cast("long")
    return joined(short, first).unionByName(joined(found, cut))


# --- windows and top-n ----------------------------------------------------------------

def tail_per_key(df: DataFrame, key: str, order: Sequence[str], n: int) -> DataFrame:
    """The last n rows per key; each input partition is cut to n per key before the shuffle.

    The place from the end is added as ``rn``, with underscores if the frame has such a column.
    """
    place = free_name("rn", df)
    w = Window.partitionBy(F.col(quoted(key))).orderBy(*[F.col(quoted(c)).desc() for c in order])
    return df.withColumn(place, F.row_number().over(w)).filter(F.col(place) <= n)


def first_rows(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


# --- upsert ---------------------------------------------------------------------------

def without(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key no source row has; a null key matches none."""
    own = source.select(*[F.col(quoted(k)) for k in keys]).alias("s")
    cond = [F.col(f"t.{quoted(k)}") == F.col(f"s.{quoted(k)}") for k in keys]
    return target.alias("t").join(own, cond, "left_anti")


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], check: bool = False
) -> DataFrame:
    """The target with source rows put in: matched keys replaced, other rows added.

    With ``check`` a source key held by two rows is an error; it costs one aggregation.
    As in SQL MERGE, a null key never matches.
    """
    if check and not dup_groups(source, keys).limit(1).isEmpty():
        raise ValueError(f"source holds several rows for one key {list(keys)}")
    cols = [F.col(quoted(c)) for c in target.columns]
    return without(target, source, keys).select(*cols).unionByName(source.select(*cols))


def delete_where(df: DataFrame, predicate: str) -> DataFrame:
    """Rows that stay after a delete: those for which the predicate is not true."""
    return df.filter(~F.coalesce(F.expr(predicate), F.lit(False)))
