"""Set operations, reshaping and nested-data queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import nested as nst
from plumbline.operators import recon, reshape
from plumbline.plans.catalog import query
from plumbline.plans.derived import NESTED_SQL, nested, pair, with_pair
from plumbline.plans.q_relational import SAMPLES_SQL
from plumbline.session import table

# --- U: set operations and reshaping ----------------------------------------------------


@query("union_all_tagged", with_pair("""
    SELECT 'left' AS side, count(*) AS row_count FROM orders
    UNION ALL SELECT 'right', count(*) FROM pair"""))
def union_all_tagged(spark, sf):
    left, right = pair(spark, sf)
    return reshape.tagged_counts({"left": left, "right": right})


@query("minus_distinct", with_pair("SELECT * FROM pair EXCEPT SELECT * FROM orders"))
def minus_distinct(spark, sf):
    left, right = pair(spark, sf)
    return reshape.minus_distinct(right, left)


@query("minus_all", with_pair("SELECT * FROM pair EXCEPT ALL SELECT * FROM orders"))
def minus_all(spark, sf):
    left, right = pair(spark, sf)
    return right.exceptAll(left)


@query("concat_keyed", """
    SELECT 'customer' AS src, c_custkey AS id, 'balance' AS attribute,
           CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS recent FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, 'balance',
           CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR) FROM supplier""")
def concat_keyed(spark, sf):
    def shape(name, key, value):
        return table(spark, sf, name).select(
            F.col(key).alias("id"), F.lit("balance").alias("attribute"),
            F.col(value).cast("decimal(18,2)").cast("string").alias("recent"))

    return reshape.concat_keyed({"customer": shape("customer", "c_custkey", "c_acctbal"),
                                 "supplier": shape("supplier", "s_suppkey", "s_acctbal")}, "src")


@query("concat_loose", """
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance
    FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""")
def concat_loose(spark, sf):
    c = table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name",
                                                "c_mktsegment AS segment")
    s = table(spark, sf, "supplier").selectExpr("s_suppkey AS id", "s_name AS name",
                                                "s_acctbal AS balance")
    return reshape.concat_loose([c, s])


@query("schema_setdiff", """
    SELECT 'left' AS side, column_name AS col_name FROM duckdb_columns()
    WHERE table_name = 'customer' AND column_name NOT IN ('c_custkey', 'c_name')
    UNION ALL SELECT 'right', column_name FROM duckdb_columns()
    WHERE table_name = 'orders' AND column_name <> 'o_custkey'""")
def schema_setdiff(spark, sf):
    c = table(spark, sf, "customer")
    o = table(spark, sf, "orders").withColumnRenamed("o_custkey", "C_CUSTKEY").withColumn(
        "c_name", F.lit(""))
    return reshape.schema_setdiff(spark, c, o)


@query("unpivot_wide", with_pair("""
    SELECT o_orderkey, 'status' AS name, o_orderstatus AS val FROM pair
      WHERE o_orderstatus IS NOT NULL
    UNION ALL SELECT o_orderkey, 'priority', o_orderpriority FROM pair"""))
def unpivot_wide(spark, sf):
    return reshape.unpivot_wide(pair(spark, sf)[1], ["o_orderkey"],
                                {"o_orderstatus": "status", "o_orderpriority": "priority"},
                                "name", "val")


def _quiz(spark, sf):
    """Each document as a question: all its words, dealt over the answer options, some blank."""
    words = F.split(F.regexp_replace("text", "[\n\t]", " "), " ")

    def option(k):
        return F.array_join(F.filter(words, lambda w, i: i % 15 == k), " ")

    opts = [option(k).alias(f"Answer Option {k + 1}") for k in range(15)]
    right = F.when(F.col("n_chars") % 2 == 0, "1, 3, 15").otherwise("2")
    return table(spark, sf, "documents").select("doc_id", *opts, right.alias("correct"))


_QUIZ_SQL = """
    quiz AS (
      SELECT doc_id, string_split(replace(replace(text, chr(10), ' '), chr(9), ' '), ' ') AS w,
             CASE WHEN n_chars % 2 = 0 THEN [1, 3, 15] ELSE [2] END AS correct FROM documents),
    options AS (
      SELECT * FROM (
        SELECT doc_id, CAST(k AS INTEGER) AS option_no, array_to_string(
                 list_filter(w, lambda x, i: (i - 1) % 15 = k - 1), ' ') AS option_text
        FROM quiz, range(1, 16) t(k)) WHERE trim(option_text) <> '')"""


@query("unpivot_options", f"WITH {_QUIZ_SQL} SELECT * FROM options")
def unpivot_options(spark, sf):
    return reshape.unpivot_options(_quiz(spark, sf), ["doc_id"], "Answer Option ")


@query("split_multiselect", f"""
    WITH {_QUIZ_SQL}, chosen AS (SELECT doc_id, unnest(correct) AS option_no FROM quiz)
    SELECT doc_id, option_no, option_text FROM chosen JOIN options USING (doc_id, option_no)""")
def split_multiselect(spark, sf):
    quiz = _quiz(spark, sf)
    chosen = reshape.split_multiselect(quiz, ["doc_id"], "correct")
    options = reshape.unpivot_options(quiz, ["doc_id"], "Answer Option ")
    return chosen.join(options, ["doc_id", "option_no"])


# --- N: nested ---------------------------------------------------------------------------


@query("nested_rows", "SELECT doc_id, 1 AS requests FROM documents")
def nested_rows(spark, sf):
    return nested(spark, sf).select("doc_id", F.lit(1).alias("requests"))


@query("nested_has_items", """
    SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN 1 ELSE 0 END AS with_item FROM documents""")
def nested_has_items(spark, sf):
    return nested(spark, sf).select("doc_id", nst.has_items(F.col("items")).alias("with_item"))


@query("nested_count_if", f"""
    WITH {NESTED_SQL} SELECT doc_id, CAST(n_flag AS INTEGER) AS flagged FROM per_doc""")
def nested_count_if(spark, sf):
    return nested(spark, sf).select(
        "doc_id", nst.count_if(F.col("items"), lambda x: x.flag).alias("flagged"))


@query("nested_size", f"WITH {NESTED_SQL} SELECT doc_id, CAST(n_items AS INTEGER) AS items FROM per_doc")
def nested_size(spark, sf):
    return nested(spark, sf).select("doc_id", nst.size0(F.col("items")).alias("items"))


@query("nested_sum_sizes", f"""
    WITH {NESTED_SQL} SELECT doc_id, CAST(n_events AS INTEGER) AS events FROM per_doc""")
def nested_sum_sizes(spark, sf):
    return nested(spark, sf).select(
        "doc_id", nst.sum_sizes(F.col("items"), lambda x: x.event).alias("events"))


@query("nested_rollup", f"""
    WITH {NESTED_SQL}
    SELECT lang, CAST(count(*) AS BIGINT) AS total_requests,
           CAST(sum(CASE WHEN n_items > 0 THEN 1 ELSE 0 END) AS BIGINT) AS total_requests_with_item,
           CAST(sum(n_flag) AS BIGINT) AS total_requests_with_item_flag_true,
           CAST(sum(n_items) AS BIGINT) AS total_items,
           CAST(sum(n_flag) AS BIGINT) AS total_flagged_items,
           CAST(sum(n_events) AS BIGINT) AS total_events_on_items
    FROM per_doc GROUP BY lang""")
def nested_rollup(spark, sf):
    return nst.item_rollup(nested(spark, sf), "lang")


@query("json_extract", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           json_extract_string(props, '$.k') AS k_text, json_extract_string(props, '$.none') AS none
    FROM events""")
def json_extract(spark, sf):
    df = nst.json_fields(table(spark, sf, "events").select("event_id", "props"), "props",
                         {"k": "int", "none": "string"})
    return df.select("event_id", "k", F.get_json_object("props", "$.k").alias("k_text"), "none")


@query("json_encode", """
    SELECT c_custkey, '["' || c_name || '","' || c_mktsegment || '"]' AS js FROM customer""")
def json_encode(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", F.to_json(F.array("c_name", "c_mktsegment")).alias("js"))


@query("json_sort_keys", """
    SELECT c_custkey, '{"a":"' || c_name || '","n":"' || c_nationkey || '","z":"' || c_mktsegment
      || '"}' AS js FROM customer""")
def json_sort_keys(spark, sf):
    mixed = F.concat(F.lit('{"z": "'), "c_mktsegment", F.lit('", "n": '), "c_nationkey",
                     F.lit(', "a": "'), "c_name", F.lit('"}'))
    return table(spark, sf, "customer").select("c_custkey", nst.sort_json_keys(mixed).alias("js"))


@query("map_of_samples", f"""
    SELECT 1 AS run, col_name, count(*) AS n FROM ({SAMPLES_SQL}) GROUP BY col_name""")
def map_of_samples(spark, sf):
    """The samples as one map column; the map is opened again to compare it."""
    left, right = pair(spark, sf)
    samples = recon.diff_samples(left, right, ["o_orderkey"], 5).withColumn("run", F.lit(1))
    packed = nst.to_map_of_samples(samples, ["run"], "col_name", 5)
    return packed.select("run", F.explode("samples").alias("col_name", "rows")).select(
        "run", "col_name", F.size("rows").cast("long").alias("n"))
