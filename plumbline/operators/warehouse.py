"""Star-schema building, constraint and type audits, table layout and upkeep."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.canonical import free_name, quoted, value_text
from plumbline.functions.scalars import date_parts
from plumbline.operators.relational import (
    hot_keys, is_hot, range_spread, salted, salted_join,
)
from plumbline.sources.lines import quoted_records
from plumbline.sources.readers import partition_columns, ragged_fields, unique_name

# --- star schema ----------------------------------------------------------------------


def date_dim(df: DataFrame, ts: str) -> DataFrame:
    """One row per calendar day from the first to the last value of a time column.

    The span is one row; every task then makes its own days from it.
    """
    span = df.agg(F.min(F.to_date(ts)).alias("lo"), F.max(F.to_date(ts)).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("full_date"))
    key = F.date_format("full_date", "yyyyMMdd").cast("int").alias("date_key")
    return days.select(key, "full_date", *date_parts(F.col("full_date")))


def star_build(
    customer: DataFrame, part: DataFrame, orders: DataFrame, lineitem: DataFrame
) -> dict[str, DataFrame]:
    """Conform the sources to typed dimensions and facts. Pure projections: no shuffle.

    Identifiers are long: a fact table of this size outgrows int.
    """
    money, cents = "decimal(10,2)", "decimal(12,2)"
    date_key = lambda c: F.date_format(c, "yyyyMMdd").cast("int").alias("date_key")
    return {
        "dim_customer": customer.select(
            F.col("c_custkey").cast("bigint").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_nationkey").alias("nation_id"),
        ),
        "dim_product": part.select(
            F.col("p_partkey").cast("bigint").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").cast(money).alias("price"),
        ),
        "fact_order": orders.select(
            F.col("o_orderkey").cast("bigint").alias("order_id"),
            F.col("o_custkey").cast("bigint").alias("customer_id"),
            date_key("o_orderdate"),
            F.col("o_totalprice").cast(cents).alias("total_amount"),
        ),
        "fact_order_item": lineitem.select(
            F.col("l_orderkey").cast("bigint").alias("order_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_partkey").cast("bigint").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_extendedprice").cast(cents).alias("amount"),
            F.coalesce(F.col("l_discount").cast(money), F.lit(0).cast(money)).alias("discount"),
        ),
    }


# --- constraints ----------------------------------------------------------------------


def check_pk(df: DataFrame, keys: Sequence[str], rule: str) -> DataFrame:
    """(rule, bad_rows): rows with a null key part or a key that another row holds too."""
    parts = df.select(*[F.col(quoted(k)).alias(f"k{i}") for i, k in enumerate(keys)])
    groups = parts.groupBy(*parts.columns).agg(F.count(F.lit(1)).alias("n"))
    has_null = F.lit(False)
    for k in parts.columns:
        has_null = has_null | F.col(k).isNull()
    bad = F.coalesce(F.sum(F.when(has_null | (F.col("n") > 1), F.col("n"))), F.lit(0))
    return groups.agg(bad.cast("long").alias("bad_rows")).select(
        F.lit(rule).alias("rule"), "bad_rows"
    )


def check_not_null(df: DataFrame, cols: Sequence[str], prefix: str = "") -> DataFrame:
    """(rule, bad_rows) per column, all in one pass."""
    one = df.agg(*[F.count_if(F.col(quoted(c)).isNull()).alias(prefix + c) for c in cols])
    return one.unpivot([], [F.col(quoted(prefix + c)) for c in cols], "rule", "bad_rows")


def check_fk(
    child: DataFrame, key: str, parent: DataFrame, parent_key: str, rule: str
) -> DataFrame:
    """(rule, bad_rows): rows that refer to a parent that is absent; null refers to none.

    References are counted per value first, so a hot value joins as one row.
    """
    refs = child.select(F.col(quoted(key)).alias("_k")).filter("_k IS NOT NULL").groupBy("_k").agg(
        F.count(F.lit(1)).alias("n")
    )
    parents = parent.select(F.col(quoted(parent_key)).alias("_k"))
    orphans = refs.join(parents, "_k", "left_anti")
    return orphans.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("bad_rows")
    ).select(F.lit(rule).alias("rule"), "bad_rows")


def apply_default(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns({
        c: F.coalesce(F.col(quoted(c)), F.lit(v).cast(df.schema[c].dataType))
        for c, v in defaults.items()
    })


def _changed(src: Column, source: T.DataType, new: Column, target: T.DataType) -> Column:
    """Does a converted value say something else than its source? Null where either is null.

    Values are compared after the way back to their own type. Numbers in text have none: they are
    compared as decimals, as doubles, and by the digits that no decimal of the target's scale holds.
    """
    timed = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(source, (T.StringType, T.BinaryType)):
        text = src.cast("string")
        if isinstance(target, timed):
            return text.try_cast("timestamp") != new.cast("timestamp")
        if not isinstance(target, T.NumericType):
            return text != new.cast("string")
        scale = max(18, getattr(target, "scale", 0))
        exact = text.try_cast(f"decimal(38,{scale})") != new.try_cast(f"decimal(38,{scale})")
        rough = text.try_cast("double") != new.try_cast("double")
        deeper = text.rlike(rf"^[^eE]*\.\d{{{scale}}}\d*[1-9]")
        return F.coalesce(exact | rough | deeper, exact, rough)
    if isinstance(target, timed) and isinstance(source, timed):
        return src.cast("timestamp") != new.cast("timestamp")
    return F.coalesce(src != new.try_cast(source), src.isNotNull() & new.isNotNull())


def type_audit(df: DataFrame, wanted: Mapping[str, str]) -> DataFrame:
    """(col_name, wanted_type, non_null, misfits, changed) for narrower column types.

    ``misfits`` do not convert at all; ``changed`` convert, but to another value. One pass.
    """
    aggs: list[Column] = []
    for i, (c, dtype) in enumerate(wanted.items()):
        src = F.col(quoted(c))
        new = src.try_cast(dtype)
        target = T.StructType.fromDDL(f"c {dtype}").fields[0].dataType
        changed = _changed(src, df.schema[c].dataType, new, target)
        aggs += [
            F.count(src).alias(f"n_{i}"),
            F.count_if(src.isNotNull() & new.isNull()).alias(f"bad_{i}"),
            F.count_if(F.coalesce(changed, F.lit(False))).alias(f"chg_{i}"),
        ]
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("col_name"), F.lit(t).alias("wanted_type"),
            F.col(f"n_{i}").alias("non_null"), F.col(f"bad_{i}").alias("misfits"),
            F.col(f"chg_{i}").alias("changed"),
        )
        for i, (c, t) in enumerate(wanted.items())
    ])
    return df.agg(*aggs).select(F.inline(rows))


def redundant_columns(df: DataFrame) -> DataFrame:
    """(col_a, col_b): columns of one type that are equal, null-safe, in every row.

    A first pass gives each column a fingerprint that ties its values to their rows; equal
    columns have equal ones. A second pass compares only the pairs with the same type and
    fingerprint, value by value, so the work is linear in the number of columns.
    """
    empty = df.sparkSession.createDataFrame([], "col_a string, col_b string")
    fields = df.schema.fields

    def plain(f: T.StructField) -> Column:
        """A value that can be hashed and compared: nested ones, which may hold maps, as text."""
        nested = isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType))
        col = F.col(quoted(f.name))
        return value_text(col, f.dataType) if nested else col

    values = {f.name: plain(f) for f in fields}
    row = F.xxhash64(*values.values())
    prints = df.agg(*[
        F.bit_xor(F.xxhash64(F.coalesce(value_text(F.col(quoted(f.name)), f.dataType), F.lit("~")),
                             row)).alias(f"p{i}")
        for i, f in enumerate(fields)
    ]).first()
    groups: dict[tuple, list[str]] = {}
    for i, f in enumerate(fields):
        groups.setdefault((f.dataType.simpleString(), prints[f"p{i}"]), []).append(f.name)
    pairs = [(a, b) for names in groups.values() for i, a in enumerate(names) for b in names[i + 1:]]
    if not pairs:
        return empty
    one = df.agg(*[
        F.coalesce(F.bool_or(~values[a].eqNullSafe(values[b])), F.lit(False))
        .alias(f"d{i}")
        for i, (a, b) in enumerate(pairs)
    ])
    rows = F.array(*[
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"d{i}").alias("differs"))
        for i, (a, b) in enumerate(pairs)
    ])
    return one.select(F.inline(rows)).filter("NOT differs").drop("differs")


# --- layout ---------------------------------------------------------------------------


def layout_key(df: DataFrame, key: str, n: int, hot_share: float | None = None) -> DataFrame:
    """Rows of a key together, over n partitions; a key above the share is spread by salt."""
    hot = hot_keys(df, key, hot_share or 1.0 / n)
    name = free_name("salt", df)
    return salted(df, key, hot, n, name).repartition(n, F.col(quoted(key)), name).drop(name)


def layout_even(df: DataFrame, n: int) -> DataFrame:
    return df.repartition(n)


def layout_sort(df: DataFrame, cols: Sequence[str], n: int | None = None) -> DataFrame:
    """Range partitions sorted by the columns, so file min/max statistics skip blocks."""
    return range_spread(df, *cols, n=n).sortWithinPartitions(*[F.col(quoted(c)) for c in cols])


def layout_skew(df: DataFrame) -> DataFrame:
    """One row: partitions in use, rows, largest partition, and largest / average."""
    sizes = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.count(F.lit(1)).alias("partitions"), F.sum("n").alias("rows"),
        F.max("n").alias("max_rows"), F.round(F.max("n") / F.avg("n"), 4).alias("skew"),
    )


def colocated_write(df: DataFrame, name: str, key: str, n: int, path: str) -> DataFrame:
    """Write a table bucketed and sorted by the join key: joins on it need no exchange."""
    df.repartition(n, key).write.mode("overwrite").format("parquet").bucketBy(n, key).sortBy(
        key
    ).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def colocated_join(
    spark: SparkSession, left: DataFrame, right: DataFrame, key: str, n: int, root: str
) -> DataFrame:
    """Inner join of two tables co-located on the key.

    One bucket is one task, so keys holding more than a bucket's share of the left rows (at
    most n of them) stay out of the buckets; their rows meet in a salted join instead.
    """
    hot = hot_keys(left, key, 1.0 / n)
    cold = ~is_hot(key, hot)
    lname, rname = unique_name("left_bucketed"), unique_name("right_bucketed")
    lhs = colocated_write(left.filter(cold), lname, key, n, f"{root}/left")
    rhs = colocated_write(right.filter(cold), rname, key, n, f"{root}/right")
    joined = lhs.hint("merge").join(rhs, key)
    if not hot:
        return joined
    return joined.unionByName(
        salted_join(left.filter(~cold), right.filter(~cold), key, hot, salts=n)
    )


# --- upkeep ---------------------------------------------------------------------------


def table_info(df: DataFrame) -> DataFrame:
    """One row: files, bytes and rows behind a file-based frame.

    Files and sizes come from the listing, so files without rows count; the row count of Parquet
    files comes from their footers.
    """
    files = df.inputFiles()
    sizes = df.sparkSession.read.format("binaryFile").load(files).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    ) if files else df.sparkSession.sql("SELECT 0L AS files, 0L AS bytes")
    return sizes.crossJoin(df.agg(F.count(F.lit(1)).alias("rows")))  # one row each


def compact(
    spark: SparkSession, source: str, target: str, file_bytes: int = 128 << 20,
    order: Sequence[str] = (),
) -> dict:
    """Rewrite a folder into files of about the target size in a new folder.

    Folder partitions stay folders. With ``order`` rows are range-dealt and sorted by it, so
    files stay skippable; without it whole files are put together in their own order, with no
    shuffle. Returns files and bytes before and after. The caller swaps the folders.
    """
    rows = spark.read.parquet(source)
    before = table_info(rows).first()
    files = max(1, -(-(before.bytes or 0) // file_bytes))
    found = partition_columns(rows)
    parts = [c for c in rows.columns if c in found]
    keys = [*parts, *[c for c in order if c not in found]]
    laid = layout_sort(rows, keys, files) if keys else rows.coalesce(files)
    laid.write.mode("overwrite").partitionBy(*parts).parquet(target)
    after = table_info(spark.read.parquet(target)).first()
    return {"files_before": before.files, "bytes_before": before.bytes,
            "files_after": after.files, "bytes_after": after.bytes, "rows": after.rows}


def recluster_dirty(
    spark: SparkSession, path: str, part: str, dirty: Sequence[object], order: Sequence[str],
    staging: str,
) -> None:
    """Sort only the partitions marked dirty; clean ones are neither read nor written.

    Sorted rows go to a staging folder first, since a folder being read cannot be replaced.
    """
    wanted = spark.read.parquet(path).filter(F.col(part).isin(list(dirty)))
    laid = layout_sort(wanted, [part, *order])
    laid.write.mode("overwrite").partitionBy(part).parquet(staging)
    spark.read.parquet(staging).sortWithinPartitions(part, *order).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(part).parquet(path)


def analyze_table(spark: SparkSession, name: str) -> DataFrame:
    """Collect column statistics and return (col_name, distinct_count, null_count) as kept."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
    rows = []
    for c in spark.table(name).columns:
        info = {r.info_name: r.info_value
                for r in spark.sql(f"DESCRIBE EXTENDED {name} `{c}`").collect()}
        rows.append((c, int(info["distinct_count"]), int(info["num_nulls"])))
    return spark.createDataFrame(rows, "col_name string, distinct_count long, null_count long")


def load_dry_run(df: DataFrame, schema: str | T.StructType) -> DataFrame:
    """(row_id, col_name, value, reason) of every all-text cell that would not load.

    Nothing is written. ``df`` holds the file's columns as text, in file order, and may carry
    a ``row_id``; target columns match by position. A value beyond the last target column is
    reported too.
    """
    target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    source = [c for c in df.columns if c != "row_id"]
    checks = []
    for i, f in enumerate(target.fields):
        text = F.col(quoted(source[i])) if i < len(source) else F.lit(None).cast("string")
        wrong = text.isNotNull() & text.try_cast(f.dataType).isNull()
        reason = F.when(wrong, F.lit(f"not a {f.dataType.simpleString()}"))
        if not f.nullable:
            reason = F.when(text.isNull(), F.lit("missing")).otherwise(reason)
        checks.append(F.struct(F.lit(f.name).alias("col_name"), text.alias("value"),
                               reason.alias("reason")))
    for name in source[len(target.fields):]:
        text = F.col(quoted(name))
        reason = F.when(text.isNotNull(), F.lit("no such column"))
        checks.append(F.struct(F.lit(name).alias("col_name"), text.alias("value"),
                               reason.alias("reason")))
    row_id = [F.col("row_id")] if "row_id" in df.columns else []
    return df.select(*row_id, F.inline(F.array(*checks))).filter(F.col("reason").isNotNull())


def load_dry_run_lines(
    spark: SparkSession, path: str, schema: str | T.StructType, header: bool = False
) -> DataFrame:
    """(file, line_no, col_name, value, reason) of every cell of quoted CSV files that would not load.

    Each record is read as it stands, whatever width the first one has: surplus cells and records
    that end early are reported with the line that they start on. Nothing is written.
    """
    target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    records = quoted_records(spark, path)
    if header:
        records = records.where("record > 1")
    cells = records.select("file", "line_no", ragged_fields(F.col("text")).alias("cells"))
    size, checks = F.size("cells"), []
    for i, f in enumerate(target.fields):
        text = F.get("cells", F.lit(i))
        text = F.when(text != "", text)
        wrong = text.isNotNull() & text.try_cast(f.dataType).isNull()
        reason = F.when(wrong, F.lit(f"not a {f.dataType.simpleString()}"))
        if not f.nullable:
            reason = F.when(text.isNull(), F.lit("missing")).otherwise(reason)
        reason = F.when(size <= i, F.lit("record ends early")).otherwise(reason)
        checks.append(F.struct(F.lit(f.name).alias("col_name"), text.alias("value"),
                               reason.alias("reason")))
    extra = F.transform(F.slice("cells", len(target.fields) + 1, F.greatest(
        size - len(target.fields), F.lit(0))), lambda x: F.struct(
            F.lit(None).cast("string").alias("col_name"), x.alias("value"),
            F.lit("no such column").alias("reason")))
    return cells.select("file", "line_no", F.inline(F.concat(F.array(*checks), extra))).where(
        "reason IS NOT NULL")


def load_check(frames: Mapping[str, tuple[DataFrame, int]]) -> DataFrame:
    """(table_name, row_count, expected, passed) after a load."""
    out = None
    for name, (df, expected) in frames.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count",
            F.lit(expected).cast("long").alias("expected"),
            (F.col("row_count") == expected).alias("passed"),
        )
        out = one if out is None else out.unionByName(one)
    return out
