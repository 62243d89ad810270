"""File and catalog readers."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_csv_infer(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; types come from a pass over the data, so prefer a schema at scale."""
    return spark.read.csv(path, header=True, inferSchema=True)


def scan_csv_skip_header(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def scan_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.option("lineSep", "\n").text(path)


def scan_delimited(
    spark: SparkSession, path: str | list[str], schema: str | T.StructType, sep: str = "|"
) -> DataFrame:
    """Headerless delimited text; compression is told from the file ending.

    A gzip file is read by one task, so land many files rather than a large one.
    """
    return spark.read.schema(schema).option("sep", sep).csv(path)


def scan_manifest(
    spark: SparkSession, manifest: str, schema: str | T.StructType, sep: str = "|"
) -> DataFrame:
    """Exactly the files a JSON manifest names: ``{"entries": [{"url": ..., "mandatory": ...}]}``.

    A named file that is missing fails the read.
    """
    entries = spark.read.option("multiLine", True).schema(
        "entries array<struct<url: string, mandatory: boolean>>"
    ).json(manifest)
    urls = [r.url for r in entries.select(F.explode("entries.url").alias("url")).collect()]
    return scan_delimited(spark, urls, schema, sep)


# Fixed pieces of a pattern: text in quotes, in which a quote is doubled, and one field after a
# separator. Possessive loops, so that a long field does not use up the stack.
_QUOTED = '"[^"]*+(?:""[^"]*+)*+"'
_FIELD = f',((?:{_QUOTED}|[^,"]++|")*+)'


def ragged_fields(line: Column) -> Column:
    """The fields of a line of quoted CSV as an array; an empty line has none.

    A field that is in quotes as a whole comes without them. Whatever else stands between two
    separators outside quotes is kept as it is.
    """
    found = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(1))
    plain = F.transform(found, lambda x: F.when(
        x.rlike(f"(?s)^{_QUOTED}$"), F.replace(F.substring(x, F.lit(2), F.length(x) - 2),
                                               F.lit('""'), F.lit('"'))).otherwise(x))
    return F.when(line == "", F.array().cast("array<string>")).otherwise(plain)


def scan_ragged_csv(spark: SparkSession, path: str, out: str = "fields") -> DataFrame:
    """Quoted CSV with any number of fields per row, as one array per row: :func:`ragged_fields`."""
    return spark.read.text(path).select(ragged_fields(F.col("value")).alias(out))


def scan_quoted_csv(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None
) -> DataFrame:
    """Quoted CSV whose fields may hold separators, doubled quotes and line breaks.

    One task reads a file; ``lines.scan_quoted_split`` reads a large one in splits.
    """
    reader = spark.read.options(header=True, multiLine=True, quote='"', escape='"')
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def scan_json_mapped(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """JSON lines with keys in any case as an all-text table with the given lower-case names.

    Each line is read as a map and its keys are lowered once, so no schema pass is needed.
    Of two keys of a line that differ only in case the last one counts.
    """
    fields = F.map_entries(F.from_json("value", "map<string,string>"))
    lowered = F.transform(fields, lambda e: F.struct(F.lower(e["key"]).alias("k"),
                                                     e["value"].alias("v")))
    keys = F.transform(lowered, lambda e: e["k"])
    values = F.transform(lowered, lambda e: e["v"])
    rows = spark.read.text(path).select(F.reverse(keys).alias("ks"), F.reverse(values).alias("vs"))
    return rows.select(*[
        F.get("vs", F.array_position("ks", n.lower()).cast("int") - 1).alias(n.lower())
        for n in names
    ])


def crawl(
    spark: SparkSession, paths: Mapping[str, str], prefix: str = "", register: bool = False
) -> DataFrame:
    """Catalog rows (table_name, position, col_name, data_type, is_partition) of Parquet sets.

    Reads file footers only; new columns of later files are merged in, and folder-name
    partitions are found. With ``register`` each set also becomes a catalog table in place.
    """
    rows = []
    for name, path in paths.items():
        df = spark.read.option("mergeSchema", True).parquet(path)
        parts = partition_columns(df)
        for i, f in enumerate(df.schema.fields):
            rows.append((prefix + name, i + 1, f.name, f.dataType.simpleString(), f.name in parts))
        if register:
            _register(spark, prefix + name, path, df.schema, parts)
    ddl = "table_name string, position int, col_name string, data_type string, is_partition boolean"
    return spark.createDataFrame(rows, ddl)


def _register(
    spark: SparkSession, name: str, path: str, schema: T.StructType, parts: set[str]
) -> None:
    """A catalog table over existing files, with the merged schema and its partitions."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    split = ", ".join(f"`{f.name}`" for f in schema.fields if f.name in parts)
    by = f" PARTITIONED BY ({split})" if split else ""
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    spark.sql(f"CREATE TABLE `{name}` ({cols}) USING parquet{by} LOCATION '{path}'")
    if split:
        spark.catalog.recoverPartitions(f"`{name}`")


def partition_columns(df: DataFrame) -> set[str]:
    """Folder-name partition columns, read off the ``name=value`` parts of a file's path."""
    one = df.select("_metadata.file_path").first()
    folders = one.file_path.split("/")[:-1] if one else []
    return {piece.split("=", 1)[0] for piece in folders if "=" in piece} & set(df.columns)


def managed_table(
    spark: SparkSession, name: str, ddl: str, provider: str = "parquet", location: str | None = None
) -> DataFrame:
    """Create a catalog table if it is absent and scan it.

    ``provider`` may be any installed table format; Parquet needs no extra jar.
    """
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING {provider}{where}")
    return spark.table(name)


def unique_name(label: str) -> str:
    """A catalog name no other run uses."""
    return f"{label}_{uuid.uuid4().hex}"
