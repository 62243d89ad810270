"""Inputs that Spark derives from the given tables, with the same rows as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import table

# --- a second version of orders with seeded defects ------------------------------------
# 1 in 97 rows dropped, 1 in 71 status nulled, 1 in 53 price raised, 1 in 211
# doubled, 1 in 301 repeated under a new key. The defects are the point of the pair; every
# row of orders takes part.

PAIR_SQL = """
    r AS (
      SELECT o_orderkey, o_custkey,
             CASE WHEN o_orderkey % 71 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
             CASE WHEN o_orderkey % 53 = 0 THEN o_totalprice + 1.0 ELSE o_totalprice END
               AS o_totalprice,
             o_orderdate, o_orderpriority
      FROM orders WHERE o_orderkey % 97 <> 0),
    pair AS (
      SELECT * FROM r
      UNION ALL SELECT * FROM r WHERE o_orderkey % 211 = 0
      UNION ALL SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice,
                       o_orderdate, o_orderpriority
                FROM r WHERE o_orderkey % 301 = 0)
"""


def with_pair(select: str) -> str:
    return f"WITH {PAIR_SQL} {select}"


def pair(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(orders, orders with seeded defects); the second reads its table once."""
    left = table(spark, folder, "orders")
    key = F.col("o_orderkey")
    none = F.array().cast("array<bigint>")
    shifts = F.concat(
        F.array(F.lit(0).cast("bigint")),
        F.when(key % 211 == 0, F.array(F.lit(0).cast("bigint"))).otherwise(none),
        F.when(key % 301 == 0, F.array(F.lit(10_000_000).cast("bigint"))).otherwise(none),
    )
    right = left.filter(key % 97 != 0).select(
        key.alias("_k"),
        F.explode(shifts).alias("_shift"),
        "o_custkey",
        F.when(key % 71 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(key % 53 == 0, F.col("o_totalprice") + 1.0).otherwise(F.col("o_totalprice"))
        .alias("o_totalprice"),
        "o_orderdate", "o_orderpriority",
    )
    return left, right.select((F.col("_k") + F.col("_shift")).alias("o_orderkey"),
                              *left.columns[1:])


# --- sales events, every field text -----------------------------------------------------

SALES_SQL = """
    sales AS (
      SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS uuid,
             n_name AS country, p_type AS itemtype,
             CASE WHEN l_returnflag = 'R' THEN 'Online' ELSE 'Offline' END AS saleschannel,
             o_orderpriority AS orderpriority,
             CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS orderdate, r_name AS region,
             CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS shipdate,
             CASE WHEN l_quantity = 50 THEN 'n/a'
                  ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS unitssold,
             CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS unitprice,
             CAST(p_size AS VARCHAR) AS unitcost,
             CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS totalrevenue,
             CAST(CAST(l_tax AS DECIMAL(12,2)) AS VARCHAR) AS totalcost,
             CAST(CAST(l_discount AS DECIMAL(12,2)) AS VARCHAR) AS totalprofit
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
           JOIN customer ON o_custkey = c_custkey
           JOIN nation ON c_nationkey = n_nationkey
           JOIN region ON n_regionkey = r_regionkey
           JOIN part ON l_partkey = p_partkey)
"""

SALES_COLUMNS = (
    "uuid", "country", "itemtype", "saleschannel", "orderpriority", "orderdate", "region",
    "shipdate", "unitssold", "unitprice", "unitcost", "totalrevenue", "totalcost", "totalprofit",
)

SALES_TYPES = {
    "uuid": "string", "country": "string", "itemtype": "string", "saleschannel": "string",
    "orderpriority": "string", "orderdate": "date", "region": "string", "shipdate": "date",
    "unitssold": "int", "unitprice": "decimal(12,2)", "unitcost": "decimal(12,2)",
    "totalrevenue": "decimal(12,2)", "totalcost": "decimal(12,2)", "totalprofit": "decimal(12,2)",
}


def sales(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with order, customer and part facts as text, some numbers unreadable."""
    t = lambda n: table(spark, folder, n)
    joined = (
        t("lineitem")
        .join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    money = lambda c: F.col(c).cast("decimal(12,2)").cast("string")
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("uuid"),
        F.col("n_name").alias("country"), F.col("p_type").alias("itemtype"),
        F.when(F.col("l_returnflag") == "R", "Online").otherwise("Offline").alias("saleschannel"),
        F.col("o_orderpriority").alias("orderpriority"),
        F.to_date("o_orderdate").cast("string").alias("orderdate"),
        F.col("r_name").alias("region"),
        F.to_date("l_shipdate").cast("string").alias("shipdate"),
        F.when(F.col("l_quantity") == 50, "n/a")
        .otherwise(F.col("l_quantity").cast("int").cast("string")).alias("unitssold"),
        money("p_retailprice").alias("unitprice"),
        F.col("p_size").cast("string").alias("unitcost"),
        money("l_extendedprice").alias("totalrevenue"),
        money("l_tax").alias("totalcost"), money("l_discount").alias("totalprofit"),
    )


# --- nested items, from the lines and words of each document ----------------------------

NESTED_SQL = """
    lines AS (
      SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line FROM documents),
    items AS (
      SELECT doc_id, length(line) % 7 AS item_type, line LIKE '%a%' AS flag,
             CASE WHEN length(line) % 3 <> 0 THEN len(string_split(line, ' ')) ELSE 0 END AS n_event
      FROM lines),
    per_doc AS (
      SELECT documents.doc_id, lang,
             CASE WHEN doc_id % 5 <> 0 THEN n ELSE 0 END AS n_items,
             CASE WHEN doc_id % 5 <> 0 THEN n_flag ELSE 0 END AS n_flag,
             CASE WHEN doc_id % 5 <> 0 THEN n_events ELSE 0 END AS n_events
      FROM documents JOIN (
        SELECT doc_id, count(*) AS n, sum(CASE WHEN flag THEN 1 ELSE 0 END) AS n_flag,
               sum(n_event) AS n_events FROM items GROUP BY doc_id) USING (doc_id))
"""


def nested(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, lang, items): one item per line with a flag and, on most lines, its words.

    Every fifth document has null items and every third line length null events, so texts of
    every size take part. Everything is row-local.
    """
    docs = table(spark, folder, "documents")
    lines = F.split("text", "\n")

    def item(line):
        words = F.transform(F.split(line, " "), lambda w: F.struct(w.alias("info1")))
        return F.struct(
            (F.length(line) % 7).alias("item_type"),
            line.contains("a").alias("flag"),
            F.when(F.length(line) % 3 != 0, words).alias("event"),
        )

    return docs.select(
        "doc_id", "lang", F.when(F.col("doc_id") % 5 != 0, F.transform(lines, item)).alias("items")
    )
