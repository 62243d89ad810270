"""Projections, joins, aggregations, sorts and top-n over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import scalars
from plumbline.functions.canonical import row_hash_hex
from plumbline.functions.sizing import task_count
from plumbline.operators import profile, recon, relational, reshape
from plumbline.operators import warehouse as wh
from plumbline.plans.catalog import query
from plumbline.plans.derived import SALES_SQL, SALES_TYPES, pair, sales, with_pair
from plumbline.session import register_views, scratch, table
from plumbline.spec import ReconSpec, prepare


# --- P: projections and predicates ------------------------------------------------------

@query("select_filter", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'MACHINERY'")
def select_filter(spark, sf):
    return table(spark, sf, "customer").filter("c_mktsegment = 'MACHINERY'").select(
        "c_custkey", "c_name"
    )


@query("project_spec", with_pair("""
    SELECT 'left' AS side, o_orderkey, o_orderstatus, o_totalprice FROM orders
    UNION ALL SELECT 'right', o_orderkey, o_orderstatus, o_totalprice FROM pair"""))
def project_spec(spark, sf):
    left, right = pair(spark, sf)
    left = left.withColumnRenamed("o_custkey", "O_CUSTKEY")
    right = right.withColumnRenamed("o_orderpriority", "Priority_Text")
    spec = ReconSpec(exclude=["O_OrderDate", "o_custkey"], exclude_left=["o_orderpriority"],
                     exclude_right=["priority_text"])
    return reshape.concat_keyed(
        {"left": prepare(left, spec, "left"), "right": prepare(right, spec, "right")}, "side"
    )


@query("rename_map", with_pair("SELECT o_orderkey, o_custkey, o_totalprice FROM pair"))
def rename_map(spark, sf):
    right = pair(spark, sf)[1].select(
        F.col("o_orderkey").alias("Order_Id"), F.col("o_custkey").alias("Buyer"), "o_totalprice"
    )
    spec = ReconSpec(rename={"order_id": "o_orderkey", "BUYER": "o_custkey"})
    return prepare(right, spec, "right")


@query("column_exprs", with_pair("""
    SELECT o_orderkey, round(o_totalprice, 0) AS o_totalprice,
           lower(o_orderpriority) AS o_orderpriority FROM pair"""))
def column_exprs(spark, sf):
    spec = ReconSpec(exclude=["o_custkey", "o_orderstatus", "o_orderdate"], column_exprs={
        "O_TOTALPRICE": "round({col}, 0)", "o_orderpriority": "lower({col})"})
    return prepare(pair(spark, sf)[1], spec, "right")


@query("type_exprs", "SELECT event_id, date_trunc('second', ts) AS ts, value FROM events")
def type_exprs(spark, sf):
    spec = ReconSpec(exclude=["user_id", "event_type", "props"])
    return prepare(table(spark, sf, "events"), spec, "left")


@query("side_filter", with_pair("""
    SELECT 'left' AS side, o_orderkey, o_totalprice FROM orders
    WHERE o_orderstatus = 'F' AND o_totalprice > 100000
    UNION ALL SELECT 'right', o_orderkey, o_totalprice FROM pair
    WHERE o_orderstatus = 'F' AND o_totalprice > 100000"""))
def side_filter(spark, sf):
    left, right = pair(spark, sf)
    spec = ReconSpec(where="o_orderstatus = 'F' AND o_totalprice > 100000",
                     exclude=["o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"])
    return reshape.concat_keyed(
        {"left": prepare(left, spec, "left"), "right": prepare(right, spec, "right")}, "side"
    )


@query("apply_mapping", """
    SELECT CAST(o_orderkey AS DOUBLE) AS order_id, CAST(o_custkey AS DOUBLE) AS person_id,
           o_orderdate AS start_date_time, CAST(o_orderdate AS DATE) AS start_date,
           o_orderpriority AS level
    FROM orders""")
def apply_mapping(spark, sf):
    return relational.apply_mapping(table(spark, sf, "orders"), [
        ("o_orderkey", "order_id", "double"), ("o_custkey", "person_id", "double"),
        ("o_orderdate", "start_date_time", "timestamp_ntz"), ("o_orderdate", "start_date", "date"),
        ("o_orderpriority", "level", "string"),
    ])


@query("retype_result", f"""
    WITH {SALES_SQL}
    SELECT uuid, CAST(orderdate AS DATE) AS orderdate, TRY_CAST(unitssold AS INTEGER) AS unitssold,
           TRY_CAST(totalrevenue AS DECIMAL(12,2)) AS totalrevenue
    FROM sales""")
def retype_result(spark, sf):
    rows = sales(spark, sf).select("uuid", "orderdate", "unitssold", "totalrevenue")
    return relational.retype(rows, [(i, c, SALES_TYPES[c]) for i, c in enumerate(rows.columns)])


@query("pick_positional", "SELECT s_suppkey AS id, s_name AS label FROM supplier")
def pick_positional(spark, sf):
    return relational.pick_positional(table(spark, sf, "supplier"), ["id", "label"])


@query("drop_cols", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def drop_cols(spark, sf):
    return table(spark, sf, "customer").drop("c_acctbal", "c_name")


@query("drop_cols_sql", "SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier")
def drop_cols_sql(spark, sf):
    return spark.sql("SELECT * EXCEPT (s_name) FROM {t}", t=table(spark, sf, "supplier"))


@query("case_flag", """
    SELECT event_id, CASE WHEN value > 50 THEN 1 ELSE 0 END AS is_large FROM events""")
def case_flag(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", scalars.flag(F.col("value") > 50).alias("is_large")
    )


@query("tag_literal", "SELECT 'orders' AS source, o_orderkey FROM orders")
def tag_literal(spark, sf):
    return table(spark, sf, "orders").select(F.lit("orders").alias("source"), "o_orderkey")


@query("null_safe_eq", with_pair("""
    SELECT p.o_orderkey, o.o_orderstatus IS NOT DISTINCT FROM p.o_orderstatus AS same_status,
           o.o_totalprice IS DISTINCT FROM p.o_totalprice AS price_differs
    FROM orders o JOIN pair p ON o.o_orderkey = p.o_orderkey"""))
def null_safe_eq(spark, sf):
    left, right = pair(spark, sf)
    joined = left.alias("l").join(right.alias("r"), F.col("l.o_orderkey") == F.col("r.o_orderkey"))
    return joined.select(
        F.col("r.o_orderkey").alias("o_orderkey"),
        F.col("l.o_orderstatus").eqNullSafe(F.col("r.o_orderstatus")).alias("same_status"),
        (~F.col("l.o_totalprice").eqNullSafe(F.col("r.o_totalprice"))).alias("price_differs"),
    )


@query("regex_pred", """
    SELECT c_custkey, regexp_matches(c_name, c_nationkey || '$') AS ends_with_nation,
           regexp_full_match(c_name, 'Customer#0*' || c_nationkey) AS is_nation
    FROM customer""")
def regex_pred(spark, sf):
    nation = F.col("c_nationkey").cast("string")
    return table(spark, sf, "customer").select(
        "c_custkey",
        scalars.matches(F.col("c_name"), F.concat(nation, F.lit("$"))).alias("ends_with_nation"),
        scalars.matches(F.col("c_name"), F.concat(F.lit("Customer#0*"), nation), whole=True)
        .alias("is_nation"),
    )


@query("date_between", """
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-08-02' - 2 * 365 AND DATE '1998-08-02'""")
def date_between(spark, sf):
    """A two-year look-back from a day. The bounds are plain timestamps, so they are pushed down."""
    end = F.expr("DATE '1998-08-02'")
    start = F.date_sub(end, 2 * 365).cast("timestamp_ntz")
    return table(spark, sf, "orders").filter(
        (F.col("o_orderdate") >= start)
        & (F.col("o_orderdate") < F.date_add(end, 1).cast("timestamp_ntz"))
    ).select("o_orderkey", "o_orderdate")


@query("ci_lookup", "SELECT c_custkey, c_name FROM customer WHERE lower(c_mktsegment) = 'building'")
def ci_lookup(spark, sf):
    wanted = F.lower(F.trim(F.lit("  Building ")))
    return table(spark, sf, "customer").filter(F.lower("c_mktsegment") == wanted).select(
        "c_custkey", "c_name"
    )


@query("distinct_rows", """
    SELECT count(*) AS n_distinct FROM (SELECT DISTINCT role, text FROM conversations)""")
def distinct_rows(spark, sf):
    rows = table(spark, sf, "conversations").select("role", "text").distinct()
    return rows.agg(F.count(F.lit(1)).alias("n_distinct"))


# --- J: joins ---------------------------------------------------------------------------

_MULTIWAY = """
    SELECT l_orderkey, l_linenumber, l_shipdate, c.n_name AS customer_nation,
           s.n_name AS supplier_nation, s_name
    FROM lineitem, orders, customer, supplier, nation c, nation s
    WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey AND l_suppkey = s_suppkey
      AND c_nationkey = c.n_nationkey AND s_nationkey = s.n_nationkey"""


@query("join_multiway", _MULTIWAY)
def join_multiway(spark, sf):
    t = lambda n: table(spark, sf, n)
    c, s = t("nation").alias("c"), t("nation").alias("s")
    return (
        t("lineitem")
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(c, F.col("c_nationkey") == F.col("c.n_nationkey"))
        .join(s, F.col("s_nationkey") == F.col("s.n_nationkey"))
        .select("l_orderkey", "l_linenumber", "l_shipdate",
                F.col("c.n_name").alias("customer_nation"),
                F.col("s.n_name").alias("supplier_nation"), "s_name")
    )


_VIEW_JOIN = """
    SELECT l_orderkey, l_linenumber, l_extendedprice, o_orderdate, c_name, n_name
    FROM order_info, lineitem, nation
    WHERE l_orderkey = o_orderkey AND c_nationkey = n_nationkey"""


@query("join_over_view", f"""
    WITH order_info AS (SELECT o_orderkey, o_orderdate, c_name, c_nationkey
                        FROM orders, customer WHERE o_custkey = c_custkey) {_VIEW_JOIN}""")
def join_over_view(spark, sf):
    register_views(spark, sf, "orders", "customer", "lineitem", "nation")
    spark.sql("""
        CREATE OR REPLACE TEMP VIEW order_info AS
        SELECT o_orderkey, o_orderdate, c_name, c_nationkey
        FROM orders, customer WHERE o_custkey = c_custkey""")
    return spark.sql(_VIEW_JOIN)


@query("join_pk_diff", with_pair("""
    SELECT o.o_orderkey, o.o_orderstatus AS left_status, p.o_orderstatus AS right_status,
           o.o_totalprice AS left_price, p.o_totalprice AS right_price
    FROM orders o JOIN pair p ON o.o_orderkey IS NOT DISTINCT FROM p.o_orderkey
     AND (o.o_orderstatus IS DISTINCT FROM p.o_orderstatus
          OR o.o_totalprice IS DISTINCT FROM p.o_totalprice)"""))
def join_pk_diff(spark, sf):
    left, right = pair(spark, sf)
    cond = recon.same_on("l", "r", ["o_orderkey"]) & recon.any_diff(
        "l", "r", ["o_orderstatus", "o_totalprice"])
    return left.alias("l").join(right.alias("r"), cond).select(
        F.col("l.o_orderkey").alias("o_orderkey"),
        F.col("l.o_orderstatus").alias("left_status"), F.col("r.o_orderstatus").alias("right_status"),
        F.col("l.o_totalprice").alias("left_price"), F.col("r.o_totalprice").alias("right_price"),
    )


@query("join_anti_nullsafe", with_pair("""
    SELECT * FROM orders o WHERE NOT EXISTS (
      SELECT 1 FROM pair p WHERE p.o_orderkey IS NOT DISTINCT FROM o.o_orderkey
        AND p.o_orderstatus IS NOT DISTINCT FROM o.o_orderstatus)"""))
def join_anti_nullsafe(spark, sf):
    left, right = pair(spark, sf)
    return relational.anti_nullsafe(left, right, ["o_orderkey", "o_orderstatus"])


@query("join_semi_hash", with_pair("""
    SELECT * FROM orders o WHERE EXISTS (
      SELECT 1 FROM (SELECT * FROM orders EXCEPT SELECT * FROM pair) d
      WHERE d.o_orderkey = o.o_orderkey)"""))
def join_semi_hash(spark, sf):
    left, right = pair(spark, sf)
    return recon.unmatched_rows(left, right)


@query("join_theta_regex", """
    WITH rules(pattern, grp) AS (VALUES ('^[1-2]', 'high'), ('^[3-5]', 'low'), ('URGENT', 'now'))
    SELECT o_orderkey, o_orderpriority, grp FROM orders LEFT JOIN rules
      ON regexp_matches(o_orderpriority, pattern)""")
def join_theta_regex(spark, sf):
    """A fixed list of three rules is the broadcast side; values match any number of rules."""
    rules = spark.createDataFrame([("^[1-2]", "high"), ("^[3-5]", "low"), ("URGENT", "now")],
                                  "pattern string, grp string")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    cond = scalars.matches(F.col("o_orderpriority"), F.col("pattern"))
    return orders.join(F.broadcast(rules), cond, "left").drop("pattern")


@query("join_by_name", """
    SELECT coalesce(a.column_name, b.column_name) AS col_name, a.t AS left_type, b.t AS right_type
    FROM (SELECT substr(column_name, 3) AS column_name,
                 CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
                   WHEN 'DOUBLE' THEN 'double' ELSE 'string' END AS t
          FROM duckdb_columns() WHERE table_name = 'customer') a
    FULL OUTER JOIN
         (SELECT substr(column_name, 3) AS column_name,
                 CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
                   WHEN 'DOUBLE' THEN 'double' ELSE 'string' END AS t
          FROM duckdb_columns() WHERE table_name = 'supplier') b
    ON a.column_name = b.column_name""")
def join_by_name(spark, sf):
    c, s = table(spark, sf, "customer"), table(spark, sf, "supplier")
    plain = lambda df: df.toDF(*[x[2:] for x in df.columns]).schema
    return recon.schema_pairs(spark, plain(c), plain(s))


@query("join_zero_fill", """
    SELECT n_name, count(s_suppkey) AS row_count FROM nation LEFT JOIN
      (SELECT * FROM supplier WHERE s_acctbal < 0) ON s_nationkey = n_nationkey
    GROUP BY n_name""")
def join_zero_fill(spark, sf):
    owing = table(spark, sf, "supplier").filter("s_acctbal < 0").select(
        F.col("s_nationkey").alias("n_nationkey"))
    nations = table(spark, sf, "nation")
    counts = relational.zero_filled_counts(owing, "n_nationkey", nations)
    return counts.join(nations, "n_nationkey").select("n_name", "row_count")


@query("join_broadcast", """
    SELECT l_orderkey, l_linenumber, s_name, n_name FROM lineitem
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""")
def join_broadcast(spark, sf):
    nation = relational.broadcast_if_small(table(spark, sf, "nation"))
    suppliers = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    suppliers = relational.broadcast_if_small(suppliers.select("s_suppkey", "s_name", "n_name"))
    return table(spark, sf, "lineitem").join(
        suppliers, F.col("l_suppkey") == F.col("s_suppkey")
    ).select("l_orderkey", "l_linenumber", "s_name", "n_name")


@query("join_colocated", """
    SELECT l_orderkey, l_linenumber, o_custkey, o_orderdate FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey""")
def join_colocated(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    root = scratch(spark, "bucketed")
    return wh.colocated_join(spark, items, orders, "l_orderkey", task_count(spark), root)


@query("join_salted", """
    SELECT event_id, e.event_type, n FROM events e JOIN
      (SELECT event_type, count(*) AS n FROM events GROUP BY event_type) t
    ON e.event_type = t.event_type""")
def join_salted(spark, sf):
    """A join on a key with a handful of values: every one is hot, so all are spread."""
    events = table(spark, sf, "events").select("event_id", "event_type")
    totals = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    tasks = task_count(spark)
    hot = relational.hot_keys(events, "event_type", 1.0 / tasks)
    return relational.salted_join(events, totals, "event_type", hot, salts=tasks).select(
        "event_id", "event_type", "n")


# --- A: aggregations --------------------------------------------------------------------

@query("count_all", "SELECT count(*) AS row_count FROM lineitem")
def count_all(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("row_count"))


_FILTER_COUNT = """
    SELECT c_mktsegment, count(*) AS customer_cnt FROM customer WHERE c_acctbal > 2000
    GROUP BY c_mktsegment"""


@query("filter_group_count", _FILTER_COUNT)
def filter_group_count(spark, sf):
    register_views(spark, sf, "customer")
    return spark.sql(_FILTER_COUNT)


@query("multi_distinct", """
    SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers,
           count(DISTINCT o_orderkey) AS orders, count(*) AS items,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS avg_price
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1 ORDER BY 1""")
def multi_distinct(spark, sf):
    """Items are reduced to one row per order before the join, so a hot order joins as one."""
    per_order = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), scalars.exact_sum(F.col("l_extendedprice")).alias("s"))
    joined = table(spark, sf, "orders").join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderpriority").agg(
        F.count_distinct("o_custkey").alias("customers"),
        F.count_distinct("o_orderkey").alias("orders"),
        F.sum("n").alias("items"),
        (F.sum("s").cast("double") / F.sum("n")).alias("avg_price"),
    ).orderBy("o_orderpriority")


@query("group_sums", """
    SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS items,
           CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS quantity,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) AS price,
           CAST(sum(CAST(l_discount AS DECIMAL(18,4))) AS DOUBLE) AS discount,
           CAST(sum(CAST(l_tax AS DECIMAL(18,4))) AS DOUBLE) AS tax,
           CAST(sum(l_linenumber) AS BIGINT) AS line_numbers
    FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def group_sums(spark, sf):
    total = lambda c, n: scalars.exact_sum(F.col(c)).cast("double").alias(n)
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("items"), total("l_quantity", "quantity"),
        total("l_extendedprice", "price"), total("l_discount", "discount"), total("l_tax", "tax"),
        F.sum("l_linenumber").alias("line_numbers"),
    )


@query("dup_groups", """
    SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def dup_groups(spark, sf):
    return relational.dup_groups(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("group_by_all", """
    SELECT role, text, count(*) AS copies FROM conversations GROUP BY ALL HAVING count(*) > 1""")
def group_by_all(spark, sf):
    return relational.dup_groups(table(spark, sf, "conversations").select("role", "text"),
                                 ["role", "text"])


@query("distinct_per_column", """
    UNPIVOT (SELECT count(DISTINCT o_orderkey) AS o_orderkey, count(DISTINCT o_custkey) AS o_custkey,
      count(DISTINCT o_orderstatus) AS o_orderstatus, count(DISTINCT o_totalprice) AS o_totalprice,
      count(DISTINCT o_orderdate) AS o_orderdate, count(DISTINCT o_orderpriority) AS o_orderpriority
      FROM orders) ON * INTO NAME col_name VALUE distinct_val_count""")
def distinct_per_column(spark, sf):
    return profile.distinct_counts(table(spark, sf, "orders")).drop("row_count")


@query("distinct_rowkey", """
    SELECT count(*) AS distinct_rows, (SELECT count(*) FROM lineitem) AS row_count
    FROM (SELECT DISTINCT * FROM lineitem)""")
def distinct_rowkey(spark, sf):
    return profile.distinct_rows_count(table(spark, sf, "lineitem"))


@query("count_true_flags", """
    UNPIVOT (SELECT count(*) FILTER (value > 50) AS large, count(*) FILTER (event_type = 'error')
             AS failed, count(*) FILTER (user_id < 10) AS early FROM events)
    ON * INTO NAME flag VALUE n""")
def count_true_flags(spark, sf):
    one = table(spark, sf, "events").agg(
        F.count_if(F.col("value") > 50).alias("large"),
        F.count_if(F.col("event_type") == "error").alias("failed"),
        F.count_if(F.col("user_id") < 10).alias("early"),
    )
    return one.unpivot([], ["large", "failed", "early"], "flag", "n")


@query("latest_per_key", """
    SELECT c_custkey AS user_id, value FROM customer LEFT JOIN
      (SELECT user_id, max_by(value, (ts, event_id)) AS value FROM events GROUP BY user_id) e
    ON c_custkey = user_id""")
def latest_per_key(spark, sf):
    keys = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return relational.latest_per_key(table(spark, sf, "events"), "user_id", ["ts", "event_id"],
                                     "value", keys)


@query("latest_row_defaults", """
    SELECT user_id, event_type,
           coalesce(CASE WHEN value > 50 THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END, 'N/A')
             AS amount
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
          FROM events) WHERE rn = 1""")
def latest_row_defaults(spark, sf):
    amount = F.when(F.col("value") > 50, F.col("value").cast("decimal(18,2)").cast("string"))
    return relational.latest_row(
        table(spark, sf, "events").withColumn("amount", amount), "user_id", ["ts", "event_id"],
        {"event_type": F.lit("N/A"), "amount": F.lit("N/A")},
    )


@query("nonnull_counts", with_pair("""
    UNPIVOT (SELECT count(o_orderkey) AS o_orderkey, count(o_custkey) AS o_custkey,
      count(o_orderstatus) AS o_orderstatus, count(o_totalprice) AS o_totalprice,
      count(o_orderdate) AS o_orderdate, count(o_orderpriority) AS o_orderpriority FROM pair)
    ON * INTO NAME col_name VALUE non_null"""))
def nonnull_counts(spark, sf):
    return profile.nonnull_counts(pair(spark, sf)[1])


@query("max_text_length", """
    SELECT max(length(c_name)) AS c_name, max(length(c_mktsegment)) AS c_mktsegment FROM customer""")
def max_text_length(spark, sf):
    return table(spark, sf, "customer").agg(
        F.max(F.length("c_name")).cast("long").alias("c_name"),
        F.max(F.length("c_mktsegment")).cast("long").alias("c_mktsegment"),
    )


@query("ordered_concat", """
    SELECT conv_id, 0::BIGINT AS part, string_agg(role || ': ' || text, chr(10) ORDER BY turn)
             AS dialogue
    FROM conversations GROUP BY conv_id""")
def ordered_concat(spark, sf):
    piece = F.concat("role", F.lit(": "), "text")
    return relational.ordered_concat(table(spark, sf, "conversations"), ["conv_id"], ["turn"],
                                     piece, "\n", out="dialogue")


@query("sales_by_category", """
    SELECT p_type AS category,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) AS total_sales
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type""")
def sales_by_category(spark, sf):
    """Sales per part are summed before the join, so a hot part joins as one row."""
    per_part = table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        scalars.exact_sum(F.col("l_extendedprice")).alias("s"))
    parts = table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("category"))
    return per_part.join(parts, F.col("l_partkey") == F.col("p_partkey")).groupBy("category").agg(
        F.sum("s").cast("double").alias("total_sales"))


@query("buying_patterns", """
    SELECT c_custkey, c_name, count(o_orderkey) AS orders,
           coalesce(CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE), 0) AS spend,
           CAST(min(o_orderdate) AS DATE) AS first_order, CAST(max(o_orderdate) AS DATE) AS last_order,
           CASE WHEN count(o_orderkey) > 1
                THEN date_diff('day', CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE))
                     / (count(o_orderkey) - 1) END AS avg_gap_days
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name""")
def buying_patterns(spark, sf):
    """Orders are reduced to one row per customer before they meet the customer table."""
    per = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count("o_orderkey").alias("orders"),
        scalars.exact_sum(F.col("o_totalprice")).cast("double").alias("spend"),
        F.to_date(F.min("o_orderdate")).alias("first_order"),
        F.to_date(F.max("o_orderdate")).alias("last_order"),
    )
    gap = F.when(F.col("orders") > 1,
                 F.datediff("last_order", "first_order") / (F.col("orders") - 1))
    joined = table(spark, sf, "customer").join(per, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select(
        "c_custkey", "c_name", F.coalesce("orders", F.lit(0)).cast("long").alias("orders"),
        F.coalesce("spend", F.lit(0.0)).alias("spend"), "first_order", "last_order",
        gap.alias("avg_gap_days"),
    )


@query("stock_levels", """
    SELECT l_partkey, l_suppkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units_out
    FROM lineitem GROUP BY l_partkey, l_suppkey""")
def stock_levels(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_partkey", "l_suppkey").agg(
        F.sum(F.col("l_quantity").cast("long")).alias("units_out"))


# --- W: windows -------------------------------------------------------------------------

@query("tail_per_key", """
    SELECT user_id, event_id, ts, value, CAST(rn AS INTEGER) AS rn FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
      FROM events) WHERE rn <= 5""")
def tail_per_key(spark, sf):
    df = table(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    return relational.tail_per_key(df, "user_id", ["ts", "event_id"], 5)


_UNPIVOT_DIFF = """
    diff AS (
      SELECT o.o_orderkey, o.o_orderstatus AS ls, p.o_orderstatus AS rs,
             o.o_totalprice AS lp, p.o_totalprice AS rp
      FROM orders o JOIN pair p ON o.o_orderkey = p.o_orderkey),
    cells AS (
      SELECT o_orderkey, 'o_orderstatus' AS col_name, ls AS left_val, rs AS right_val FROM diff
      WHERE ls IS DISTINCT FROM rs
      UNION SELECT o_orderkey, 'o_totalprice', CAST(lp AS VARCHAR), CAST(rp AS VARCHAR) FROM diff
      WHERE lp IS DISTINCT FROM rp)"""

SAMPLES_SQL = with_pair(f""", {_UNPIVOT_DIFF}
    SELECT o_orderkey, col_name, left_val, right_val FROM (
      SELECT *, row_number() OVER (PARTITION BY col_name ORDER BY o_orderkey, left_val, right_val)
        AS rn FROM cells) WHERE rn <= 5""")


@query("sample_per_group", SAMPLES_SQL)
def sample_per_group(spark, sf):
    left, right = pair(spark, sf)
    return recon.diff_samples(left, right, ["o_orderkey"], 5)


# --- O: sorts and limits ----------------------------------------------------------------

@query("sort_multi", """
    SELECT c_mktsegment, c_nationkey, c_custkey FROM customer
    ORDER BY c_mktsegment, c_nationkey, c_custkey""")
def sort_multi(spark, sf):
    df = table(spark, sf, "customer").select("c_mktsegment", "c_nationkey", "c_custkey")
    return relational.sort_spread(df, "c_mktsegment", "c_nationkey", "c_custkey")


_PART_COUNTS = """
    UNPIVOT (SELECT count(DISTINCT p_partkey) AS p_partkey, count(DISTINCT p_name) AS p_name,
      count(DISTINCT p_brand) AS p_brand, count(DISTINCT p_type) AS p_type,
      count(DISTINCT p_size) AS p_size, count(DISTINCT p_retailprice) AS p_retailprice FROM part)
    ON * INTO NAME col_name VALUE distinct_val_count"""


@query("sort_desc", _PART_COUNTS)
def sort_desc(spark, sf):
    counts = profile.distinct_counts(table(spark, sf, "part")).drop("row_count")
    return counts.orderBy(F.desc("distinct_val_count"), "col_name")


@query("sort_asc", _PART_COUNTS)
def sort_asc(spark, sf):
    counts = profile.distinct_counts(table(spark, sf, "part")).drop("row_count")
    return counts.orderBy("distinct_val_count", "col_name")


_ORDINAL = """
    SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2 ORDER BY 1, 3 DESC, 2"""


@query("sort_ordinal", _ORDINAL)
def sort_ordinal(spark, sf):
    register_views(spark, sf, "events")
    return spark.sql(_ORDINAL)


@query("sort_all_limit", """
    SELECT p_type, p_size, p_partkey, p_name FROM part
    ORDER BY p_type, p_size, p_partkey, p_name LIMIT 100""")
def sort_all_limit(spark, sf):
    df = table(spark, sf, "part").select("p_type", "p_size", "p_partkey", "p_name")
    return relational.first_rows(df, df.columns, 100)


@query("take_first", "SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 10")
def take_first(spark, sf):
    df = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return relational.first_rows(df, ["doc_id"], 10)


@query("limit_sample", with_pair("""
    SELECT * FROM orders o WHERE EXISTS (
      SELECT 1 FROM (SELECT * FROM orders EXCEPT SELECT * FROM pair) d
      WHERE d.o_orderkey = o.o_orderkey) ORDER BY o_orderkey LIMIT 5"""))
def limit_sample(spark, sf):
    left, right = pair(spark, sf)
    return recon.sample_unmatched(left, right, 5)


# --- F: scalar functions ----------------------------------------------------------------

@query("trunc_seconds", "SELECT event_id, date_trunc('second', ts) AS ts FROM events")
def trunc_seconds(spark, sf):
    return table(spark, sf, "events").select("event_id", scalars.trunc_seconds(F.col("ts")).alias("ts"))


@query("epoch_to_date", """
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events""")
def epoch_to_date(spark, sf):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return table(spark, sf, "events").select("event_id", scalars.epoch_to_date(seconds).alias("day"))


@query("next_fridays", """
    SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, CAST(CAST(o_orderdate AS DATE)
      + CAST((12 - dayofweek(o_orderdate)) % 7 + 7 * k AS INTEGER) AS DATE) AS friday
    FROM orders, range(4) t(k)""")
def next_fridays(spark, sf):
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.select("day", F.explode(scalars.next_fridays(F.col("day"), 4)).alias("friday"))


@query("date_parts", """
    SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, CAST(year(o_orderdate) AS INTEGER) AS year,
      CAST(quarter(o_orderdate) AS INTEGER) AS quarter, CAST(month(o_orderdate) AS INTEGER) AS month,
      CAST(week(o_orderdate) AS INTEGER) AS week,
      CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS day_of_week,
      CAST(day(o_orderdate) AS INTEGER) AS day_of_month
    FROM orders""")
def date_parts(spark, sf):
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.select("day", *scalars.date_parts(F.col("day")))


_MARK = "coalesce(length({0}) || ':' || {0}, '~')"


@query("row_hash", f"""
    SELECT c_custkey, sha256({' || '.join(_MARK.format(c) for c in (
        "CAST(c_custkey AS VARCHAR)", "c_name", "CAST(c_nationkey AS VARCHAR)",
        "CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR)", "c_mktsegment"))}) AS row_hash
    FROM customer""")
def row_hash(spark, sf):
    df = table(spark, sf, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)"))
    return df.select("c_custkey", row_hash_hex(df).alias("row_hash"))


@query("key_text", """
    SELECT DISTINCT length(CAST(l_orderkey AS VARCHAR)) || ':' || l_orderkey
      || length(CAST(l_linenumber AS VARCHAR)) || ':' || l_linenumber AS pk FROM lineitem""")
def key_text(spark, sf):
    df = table(spark, sf, "lineitem")
    return df.select(recon.key_text(df, ["l_orderkey", "l_linenumber"]).alias("pk")).distinct()


@query("scalar_text", """
    SELECT c_custkey, lower(c_name) AS low, upper(c_mktsegment) AS up,
           replace(c_name, 'Customer', 'C') AS swapped, trim('  ' || c_mktsegment || ' ') AS trimmed,
           CAST(length(c_name) AS INTEGER) AS n, split_part(c_mktsegment || '.main.' || c_name, '.', 3)
             AS tail
    FROM customer""")
def scalar_text(spark, sf):
    dotted = F.concat_ws(".", "c_mktsegment", F.lit("main"), "c_name")
    return table(spark, sf, "customer").select(
        "c_custkey", F.lower("c_name").alias("low"), F.upper("c_mktsegment").alias("up"),
        F.replace("c_name", F.lit("Customer"), F.lit("C")).alias("swapped"),
        F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("trimmed"),
        F.length("c_name").alias("n"), scalars.name_part(dotted, 3).alias("tail"),
    )


@query("scalar_numbers", """
    SELECT o_orderkey, round(o_totalprice, 0) AS rounded, CAST(o_orderkey AS VARCHAR) AS key_text,
           coalesce(nullif(o_custkey, 1), 0) AS cust, coalesce(o_totalprice > 1000, FALSE) AS big
    FROM orders""")
def scalar_numbers(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.round("o_totalprice", 0).alias("rounded"),
        F.col("o_orderkey").cast("string").alias("key_text"),
        scalars.zero_if_null(F.nullif("o_custkey", F.lit(1))).alias("cust"),
        F.nvl(F.col("o_totalprice") > 1000, F.lit(False)).alias("big"),
    )


@query("text_to_list", """
    SELECT c_custkey, unnest([c_name, c_mktsegment]) AS item FROM customer""")
def text_to_list(spark, sf):
    text = F.to_json(F.array("c_name", "c_mktsegment"))
    return table(spark, sf, "customer").select(
        "c_custkey", F.explode(scalars.text_to_list(text)).alias("item"))


@query("owner_stamp", "SELECT o_orderkey, TRUE AS stamped FROM orders")
def owner_stamp(spark, sf):
    """The running user's name differs per machine, so only its presence is compared."""
    return table(spark, sf, "orders").select(
        "o_orderkey", (F.length(F.current_user()) > 0).alias("stamped"))


_LINES = "(SELECT unnest(string_split(text, chr(10))) AS line FROM documents)"


@query("text_sort", f"SELECT line FROM {_LINES} ORDER BY line")
def text_sort(spark, sf):
    return relational.sort_spread(reshape.lines_of(table(spark, sf, "documents"), "text"), "line")


@query("text_unique", f"SELECT DISTINCT line FROM {_LINES}")
def text_unique(spark, sf):
    return reshape.lines_of(table(spark, sf, "documents"), "text").distinct()


@query("text_grep", f"SELECT line FROM {_LINES} WHERE regexp_matches(line, '[0-9]')")
def text_grep(spark, sf):
    return reshape.lines_of(table(spark, sf, "documents"), "text").filter(F.col("line").rlike("[0-9]"))


@query("text_grep_v", f"SELECT line FROM {_LINES} WHERE NOT regexp_matches(line, 'the|que')")
def text_grep_v(spark, sf):
    return reshape.lines_of(table(spark, sf, "documents"), "text").filter(
        ~F.col("line").rlike("the|que"))


@query("text_sed", f"SELECT regexp_replace(line, '[aeiou]+', '_', 'g') AS line FROM {_LINES}")
def text_sed(spark, sf):
    return reshape.lines_of(table(spark, sf, "documents"), "text").select(
        F.regexp_replace("line", "[aeiou]+", "_").alias("line"))


@query("text_field", f"""
    SELECT string_split_regex(regexp_replace(line, '^[ \\t]+', ''), '[ \\t]+')[1] AS field
    FROM {_LINES}""")
def text_field(spark, sf):
    return reshape.lines_of(table(spark, sf, "documents"), "text").select(
        reshape.field_of(F.col("line"), 1).alias("field"))
