"""Queries over the readers: the data is exported to a fresh folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import reshape
from plumbline.plans.catalog import query
from plumbline.plans.derived import SALES_COLUMNS, SALES_SQL, sales
from plumbline.session import TABLES, scratch, table
from plumbline.sources import html_pages, lines, readers, sinks


@query("scan_csv_infer", """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
    FROM orders""")
def scan_csv_infer(spark, sf):
    path = scratch(spark, "orders-csv")
    sinks.sink_csv(table(spark, sf, "orders"), path)
    df = readers.scan_csv_infer(spark, path)
    return df.select(
        F.col("o_orderkey").cast("long").alias("o_orderkey"),
        F.col("o_custkey").cast("long").alias("o_custkey"), "o_orderstatus",
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
        F.to_date("o_orderdate").alias("o_orderdate"), "o_orderpriority",
    )


@query("scan_text_lines", """
    SELECT unnest(string_split(text, chr(10))) AS value FROM documents""")
def scan_text_lines(spark, sf):
    path = scratch(spark, "documents-text")
    table(spark, sf, "documents").select("text").write.option("lineSep", "\n").text(path)
    return readers.scan_text_lines(spark, path)


@query("frame_from_rows", """
    SELECT event_id, e.event_type, weight
    FROM events e LEFT JOIN (VALUES ('click', 1), ('view', 2), ('purchase', 3)) w(event_type, weight)
      ON e.event_type = w.event_type""")
def frame_from_rows(spark, sf):
    weights = spark.createDataFrame(
        [("click", 1), ("view", 2), ("purchase", 3)], "event_type string, weight int"
    )
    return table(spark, sf, "events").join(weights, "event_type", "left").select(
        "event_id", "event_type", "weight"
    )


@query("scan_table", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def scan_table(spark, sf):
    name = readers.unique_name("saved_customer")
    sinks.sink_overwrite(table(spark, sf, "customer"), name, scratch(spark, name))
    return spark.table(name).select("c_custkey", "c_name", "c_nationkey", "c_acctbal")


@query("scan_parquet", """
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00'""")
def scan_parquet(spark, sf):
    return table(spark, sf, "lineitem").filter(
        F.col("l_shipdate") >= F.expr("TIMESTAMP_NTZ '1998-01-01 00:00:00'")
    ).select("l_orderkey", "l_linenumber", "l_quantity")


@query("scan_delimited", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_delimited(spark, sf):
    df = table(spark, sf, "customer")
    path = scratch(spark, "customer-gz")
    df.write.option("sep", "|").option("compression", "gzip").csv(path)
    return readers.scan_delimited(spark, path, df.schema)


@query("scan_manifest", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def scan_manifest(spark, sf):
    """Two exports lie in the folder; the manifest names the files of one."""
    df = table(spark, sf, "supplier")
    root = scratch(spark, "supplier-manifest")
    df.write.option("sep", "|").csv(f"{root}/wanted")
    df.write.option("sep", "|").csv(f"{root}/other")
    files = spark.read.text(f"{root}/wanted").inputFiles()
    entries = [[(f, True) for f in files]]
    spark.createDataFrame(
        [(e,) for e in entries], "entries array<struct<url: string, mandatory: boolean>>"
    ).coalesce(1).write.json(f"{root}/manifest")
    return readers.scan_manifest(spark, f"{root}/manifest", df.schema)


@query("scan_csv_skip_header", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def scan_csv_skip_header(spark, sf):
    df = table(spark, sf, "part")
    path = scratch(spark, "part-csv")
    sinks.sink_csv(df, path)
    return readers.scan_csv_skip_header(spark, path, df.schema)


_RAGGED = """
    SELECT 'page ' || page_id AS group_name, CAST(pos AS INTEGER) AS pos, name FROM (
      SELECT page_id, unnest(parts) || ', part' AS name, unnest(range(1, len(parts) + 1)) AS pos
      FROM (SELECT page_id, list_filter(string_split(url, '/'), lambda x: x <> '') AS parts
            FROM pages))"""


def _ragged(spark, sf):
    """(group, part, part, ...) lines made of the parts of each page address."""
    parts = F.filter(F.split("url", "/"), lambda x: x != "")
    quoted = F.transform(parts, lambda x: F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')),
                                                   F.lit(', part"')))
    line = F.concat(F.lit('"page '), F.col("page_id"), F.lit('",'), F.array_join(quoted, ","))
    pages = table(spark, sf, "pages")
    path = scratch(spark, "ragged")
    pages.select(line.alias("value")).write.text(path)
    return readers.scan_ragged_csv(spark, path)


@query("scan_ragged_csv", """
    SELECT 'page ' || page_id AS group_name, len(list_filter(string_split(url, '/'),
           lambda x: x <> '')) AS n_names FROM pages""")
def scan_ragged_csv(spark, sf):
    return _ragged(spark, sf).select(
        F.get("fields", F.lit(0)).alias("group_name"),
        (F.size("fields") - 1).cast("long").alias("n_names"),
    )


@query("explode_ragged", _RAGGED)
def explode_ragged(spark, sf):
    return reshape.explode_ragged(_ragged(spark, sf), "fields")


@query("scan_quoted_csv", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def scan_quoted_csv(spark, sf):
    df = table(spark, sf, "documents")
    path = scratch(spark, "documents-csv")
    sinks.sink_csv(df, path)
    return readers.scan_quoted_csv(spark, path, df.schema)


@query("scan_quoted_split", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def scan_quoted_split(spark, sf):
    """Texts with line breaks in large files, each read in splits of 256 KB.

    A file is written for each read partition of the table, so no task writes the whole table.
    """
    df = table(spark, sf, "documents")
    path = scratch(spark, "documents-large-csv")
    sinks.sink_csv(df, path)
    key, size = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(key, 256 << 10)
    try:
        rows = lines.scan_quoted_split(spark, path, df.schema)
        out = scratch(spark, "documents-again")
        rows.write.parquet(out)
    finally:
        spark.conf.set(key, size)
    return spark.read.parquet(out)


def sales_json(spark, sf) -> str:
    """Sales events exported as gzipped JSON whose keys are in upper and mixed case."""
    path = scratch(spark, "sales-json")
    df = sales(spark, sf)
    names = [c.upper() if i % 2 else c.title() for i, c in enumerate(df.columns)]
    df.toDF(*names).write.option("compression", "gzip").json(path)
    return path


@query("scan_json_mapped", f"WITH {SALES_SQL} SELECT * FROM sales")
def scan_json_mapped(spark, sf):
    return readers.scan_json_mapped(spark, sales_json(spark, sf), SALES_COLUMNS)


@query("crawl_schema", """
    SELECT 'raw_' || table_name AS table_name, CAST(column_index AS INTEGER) AS position,
           column_name AS col_name,
           CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
             WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double'
             WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>'
             ELSE data_type END AS data_type,
           FALSE AS is_partition
    FROM duckdb_columns()
    WHERE table_name IN ('region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem',
      'events', 'documents', 'embeddings', 'pages', 'benchmark', 'labels', 'conversations')""")
def crawl_schema(spark, sf):
    return readers.crawl(spark, {t: f"{sf}/{t}.parquet" for t in TABLES}, prefix="raw_")


@query("iceberg_table", "SELECT p_partkey, p_name, p_retailprice FROM part")
def iceberg_table(spark, sf):
    name = readers.unique_name("lake_part")
    df = table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    readers.managed_table(
        spark, name, "p_partkey bigint, p_name string, p_retailprice double",
        location=scratch(spark, name),
    )
    df.write.insertInto(name)
    return readers.managed_table(spark, name, "p_partkey bigint, p_name string, p_retailprice double")


def customer_pages(spark, sf):
    """One page per customer with two tables: an address card and two balance quotes."""
    def row(tag, *cells):
        inner = [F.concat(F.lit(f"<{tag}>"), F.lit(c) if isinstance(c, str) else c,
                          F.lit(f"</{tag}>")) for c in cells]
        return F.concat(F.lit("<tr>"), *inner, F.lit("</tr>"))

    bal = F.col("c_acctbal").cast("decimal(12,2)").cast("string")
    html = F.concat(
        F.lit("<html><body><table>"), row("th", "Name", "Segment"),
        row("td", F.col("c_name"), F.col("c_mktsegment")),
        F.lit("</table><p>x</p><table>"), row("th", "Kind", "Value"),
        row("td", "balance", bal), row("td", "nation", F.col("c_nationkey").cast("string")),
        F.lit("</table>"),
        F.lit('<div class="quote"><span class="amount">'), bal,
        F.lit('</span><span class="segment">'), F.col("c_mktsegment"),
        F.lit("</span></div></body></html>"),
    )
    return table(spark, sf, "customer").select("c_custkey", html.alias("html"))


@query("scan_html_tables", """
    SELECT c_custkey, 1 AS row_no, c_name AS "Name", c_mktsegment AS "Segment" FROM customer""")
def scan_html_tables(spark, sf):
    rows = html_pages.html_tables(customer_pages(spark, sf), "html", ["c_custkey"], 0)
    return html_pages.table_columns(rows, ["Name", "Segment"], ["c_custkey"])
