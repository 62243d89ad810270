"""Text, links, fields and tables out of HTML pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import relational
from plumbline.plans.catalog import query
from plumbline.plans.q_sources import customer_pages
from plumbline.session import table
from plumbline.sources import html_pages


def _unescape(expr: str) -> str:
    """The character references of the pages; the last semicolon may be missing."""
    for ref, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("amp", "&")):
        expr = f"regexp_replace({expr}, '&{ref};?', '{char}', 'g')"
    return expr


@query("html_paragraphs")
def html_paragraphs(spark, sf):
    return html_pages.html_paragraphs(table(spark, sf, "pages"), "html", ["page_id"])


@query("html_main_text", f"""
    SELECT page_id, {_unescape("regexp_replace(art, '<[^>]*>', '', 'g')")} AS main_text,
           {_unescape("regexp_extract(art, '^<h1>(.*?)</h1>', 1, 's')")} AS heading
    FROM (SELECT page_id, regexp_extract(html, '<article>(.*?)</article>', 1, 's') AS art
          FROM pages)""")
def html_main_text(spark, sf):
    return html_pages.html_main_text(table(spark, sf, "pages"), "html", ["page_id"], "article")


@query("html_heading", f"""
    SELECT page_id, {_unescape("regexp_extract(html, '<article><h1>(.*?)</h1>', 1, 's')")} AS heading
    FROM pages""")
def html_heading(spark, sf):
    pages = table(spark, sf, "pages")
    return html_pages.html_main_text(pages, "html", ["page_id"], "article").select("page_id", "heading")


@query("html_next_link", f"""
    SELECT page_id, {_unescape('''regexp_extract(html, '<nav>.*?<a href="([^"]*)"', 1, 's')''')}
             AS next_link FROM pages""")
def html_next_link(spark, sf):
    return html_pages.html_next_link(table(spark, sf, "pages"), "html", ["page_id"], "nav")


@query("html_class_fields", """
    SELECT c_custkey, 1 AS row_no, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS amount,
           c_mktsegment AS segment FROM customer""")
def html_class_fields(spark, sf):
    return html_pages.html_class_fields(
        customer_pages(spark, sf), "html", ["c_custkey"], "div", "quote",
        [("amount", "span", "amount"), ("segment", "span", "segment")])


@query("html_list_items", f"""
    SELECT page_id, CAST(pos AS INTEGER) AS row_no, {_unescape("item")} AS label FROM (
      SELECT page_id, unnest(items) AS item, unnest(range(1, len(items) + 1)) AS pos FROM (
        SELECT page_id, regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1) AS items
        FROM pages))""")
def html_list_items(spark, sf):
    return html_pages.html_class_fields(
        table(spark, sf, "pages"), "html", ["page_id"], "li", None, [("label", "a", None)])


@query("html_tables", """
    SELECT c_custkey, 1 AS row_no, 'balance' AS "Kind",
           CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS "Value" FROM customer
    UNION ALL SELECT c_custkey, 2, 'nation', CAST(c_nationkey AS VARCHAR) FROM customer""")
def html_tables(spark, sf):
    rows = html_pages.html_tables(customer_pages(spark, sf), "html", ["c_custkey"], 1)
    return html_pages.table_columns(rows, ["Kind", "Value"], ["c_custkey"])


@query("page_union", """
    SELECT 1 + 20 * c_custkey AS page_offset, c_name AS name, c_mktsegment AS segment FROM customer""")
def page_union(spark, sf):
    """Rows of all result pages in one pass; the offset of a page steps by 20."""
    pages = customer_pages(spark, sf).withColumn("page_offset", 1 + 20 * F.col("c_custkey"))
    rows = html_pages.html_tables(pages, "html", ["page_offset"], 0)
    return html_pages.table_columns(rows, ["Name", "Segment"], ["page_offset"]).select(
        "page_offset", F.col("Name").alias("name"), F.col("Segment").alias("segment"))


@query("article_digest", """
    SELECT user_id, 0::BIGINT AS part,
           string_agg('Date: ' || strftime(ts, '%Y-%m-%d') || chr(10) || 'Title: ' || event_type
             || chr(10) || 'Text: ' || props, chr(10) || chr(10) || '---' || chr(10) || chr(10)
             ORDER BY ts, event_id) AS digest
    FROM events GROUP BY user_id""")
def article_digest(spark, sf):
    """Dated blocks per user in time order."""
    day = F.date_format("ts", "yyyy-MM-dd")
    block = F.concat(F.lit("Date: "), day, F.lit("\nTitle: "), "event_type", F.lit("\nText: "), "props")
    return relational.ordered_concat(
        table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], block, "\n\n---\n\n",
        out="digest")
