"""Star schema, constraint and type audits, table layout and upkeep."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions.sizing import broadcast_if_small, task_count
from plumbline.operators import warehouse as wh
from plumbline.plans.catalog import query
from plumbline.plans.derived import SALES_SQL, sales
from plumbline.session import scratch, table
from plumbline.sources import lines, manifest, readers, sinks


@query("date_dim", """
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
      CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
      CAST(month(d) AS INTEGER) AS month, CAST(week(d) AS INTEGER) AS week,
      CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, CAST(day(d) AS INTEGER) AS day_of_month
    FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d
          FROM orders)""")
def date_dim(spark, sf):
    return wh.date_dim(table(spark, sf, "orders"), "o_orderdate")


def _star(spark, sf):
    return wh.star_build(*[table(spark, sf, n) for n in ("customer", "part", "orders", "lineitem")])


@query("star_build", """
    SELECT segment, category, year, quarter, count(*) AS items, CAST(sum(quantity) AS BIGINT) AS units,
           CAST(sum(amount) AS DOUBLE) AS revenue
    FROM (SELECT c_mktsegment AS segment, p_type AS category, CAST(year(o_orderdate) AS INTEGER) AS year,
                 CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
                 CAST(l_quantity AS INTEGER) AS quantity,
                 CAST(l_extendedprice AS DECIMAL(12,2)) AS amount
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey)
    GROUP BY ALL""")
def star_build(spark, sf):
    """A report over the star: items and revenue per segment, category and quarter."""
    star = _star(spark, sf)
    dates = wh.date_dim(table(spark, sf, "orders"), "o_orderdate")
    items = star["fact_order_item"].select("order_id", "product_id", "quantity", "amount")
    orders = star["fact_order"].select("order_id", "customer_id", "date_key")
    return (
        items.join(orders, "order_id")
        .join(star["dim_customer"].select("customer_id", "segment"), "customer_id")
        .join(star["dim_product"].select("product_id", "category"), "product_id")
        .join(dates.select("date_key", "year", "quarter"), "date_key")
        .groupBy("segment", "category", "year", "quarter")
        .agg(F.count(F.lit(1)).alias("items"), F.sum("quantity").alias("units"),
             F.sum("amount").cast("double").alias("revenue"))
    )


@query("star_fact_order_item", """
    SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS amount, CAST(l_discount AS DECIMAL(10,2)) AS discount
    FROM lineitem""")
def star_fact_order_item(spark, sf):
    return _star(spark, sf)["fact_order_item"]


@query("check_pk", """
    SELECT 'orders.o_orderkey' AS rule, CAST(coalesce(sum(n), 0) AS BIGINT) AS bad_rows FROM
      (SELECT count(*) AS n FROM orders GROUP BY o_orderkey HAVING count(*) > 1 OR o_orderkey IS NULL)
    UNION ALL SELECT 'lineitem.l_orderkey,l_linenumber', CAST(coalesce(sum(n), 0) AS BIGINT) FROM
      (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def check_pk(spark, sf):
    return wh.check_pk(table(spark, sf, "orders"), ["o_orderkey"], "orders.o_orderkey").unionByName(
        wh.check_pk(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"],
                    "lineitem.l_orderkey,l_linenumber"))


@query("check_not_null", """
    UNPIVOT (SELECT count(*) - count(c_custkey) AS "customer.c_custkey",
      count(*) - count(c_name) AS "customer.c_name",
      count(*) FILTER (c_mktsegment = 'BUILDING') AS "customer.c_mktsegment" FROM customer)
    ON * INTO NAME rule VALUE bad_rows""")
def check_not_null(spark, sf):
    """One segment is blanked first, so that a column has something to find."""
    df = table(spark, sf, "customer").withColumn(
        "c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return wh.check_not_null(df, ["c_custkey", "c_name", "c_mktsegment"], "customer.")


@query("check_fk", """
    SELECT 'orders.o_custkey' AS rule, count(*) AS bad_rows FROM orders
      WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
    UNION ALL SELECT 'lineitem.l_partkey', count(*) FROM lineitem
      WHERE l_partkey NOT IN (SELECT p_partkey FROM part)""")
def check_fk(spark, sf):
    """Customers in debt are left out of the parent, so that their orders are orphans."""
    parents = table(spark, sf, "customer").filter("c_acctbal >= 0")
    return wh.check_fk(table(spark, sf, "orders"), "o_custkey", parents, "c_custkey",
                       "orders.o_custkey").unionByName(
        wh.check_fk(table(spark, sf, "lineitem"), "l_partkey", table(spark, sf, "part"),
                    "p_partkey", "lineitem.l_partkey"))


@query("apply_default", """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0.05 THEN 0.0 ELSE l_discount END
             AS l_discount FROM lineitem""")
def apply_default(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.nullif(
        "l_discount", F.lit(0.05)).alias("l_discount"))
    return wh.apply_default(df, {"l_discount": 0})


@query("type_audit", f"""
    WITH {SALES_SQL}
    SELECT 'unitssold' AS col_name, 'int' AS wanted_type, count(unitssold) AS non_null,
           count(*) FILTER (TRY_CAST(unitssold AS INTEGER) IS NULL) AS misfits, 0::BIGINT AS changed
      FROM sales
    UNION ALL SELECT 'totalrevenue', 'decimal(12,1)', count(*), 0,
           count(*) FILTER (TRY_CAST(totalrevenue AS DECIMAL(12,1)) <> TRY_CAST(totalrevenue AS DECIMAL(12,2)))
      FROM sales
    UNION ALL SELECT 'orderdate', 'date', count(*), 0, 0 FROM sales""")
def type_audit(spark, sf):
    rows = sales(spark, sf).select("unitssold", "totalrevenue", "orderdate")
    return wh.type_audit(rows, {"unitssold": "int", "totalrevenue": "decimal(12,1)",
                                "orderdate": "date"})


@query("check_redundant_columns", """
    SELECT col_a, col_b FROM (
      SELECT 'o_orderkey' AS col_a, 'order_copy' AS col_b,
             bool_and(o_orderkey IS NOT DISTINCT FROM o_orderkey) AS same FROM orders
      UNION ALL SELECT 'o_orderkey', 'o_custkey', bool_and(o_orderkey = o_custkey) FROM orders
      UNION ALL SELECT 'o_custkey', 'order_copy', bool_and(o_orderkey = o_custkey) FROM orders
      UNION ALL SELECT 'o_orderstatus', 'o_orderpriority',
                       bool_and(o_orderstatus = o_orderpriority) FROM orders) WHERE same""")
def check_redundant_columns(spark, sf):
    return wh.redundant_columns(table(spark, sf, "orders").withColumn("order_copy", F.col("o_orderkey")))


# --- layout -----------------------------------------------------------------------------

_ITEMS = "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem"


def _items(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("layout_key", _ITEMS)
def layout_key(spark, sf):
    return wh.layout_key(_items(spark, sf), "l_orderkey", task_count(spark))


@query("layout_even", _ITEMS)
def layout_even(spark, sf):
    return wh.layout_even(_items(spark, sf), task_count(spark))


@query("layout_all", """
    SELECT l_orderkey, l_linenumber, p_name FROM lineitem JOIN part ON l_partkey = p_partkey""")
def layout_all(spark, sf):
    """A small dimension copied to every executor, once its size is proven."""
    parts = broadcast_if_small(table(spark, sf, "part").select("p_partkey", "p_name"))
    return _items(spark, sf).join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", "p_name")


@query("layout_skew", """
    SELECT layout, count(*) AS "rows", TRUE AS all_used, TRUE AS balanced
    FROM events, (VALUES ('by type, salted'), ('even')) t(layout) GROUP BY layout""")
def layout_skew(spark, sf):
    """Events have five types; salting still spreads them over all partitions."""
    events, n = table(spark, sf, "events").select("event_id", "event_type"), 4
    out = None
    for name, laid in (("by type, salted", wh.layout_key(events, "event_type", n)),
                       ("even", wh.layout_even(events, n))):
        one = wh.layout_skew(laid).select(
            F.lit(name).alias("layout"), "rows", (F.col("partitions") == n).alias("all_used"),
            (F.col("skew") <= 2).alias("balanced"))
        out = one if out is None else out.unionByName(one)
    return out


@query("layout_sort", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def layout_sort(spark, sf):
    path = scratch(spark, "sorted")
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    wh.layout_sort(df, ["o_orderdate"]).write.parquet(path)
    return spark.read.parquet(path)


def _orders_by_year(spark, sf, label):
    path = scratch(spark, label)
    df = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate", F.year("o_orderdate").alias("year"))
    df.write.partitionBy("year").parquet(path)
    return path


@query("recluster_tail", """
    SELECT o_orderkey, o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""")
def recluster_tail(spark, sf):
    path = _orders_by_year(spark, sf, "by-year")
    last = spark.read.parquet(path).agg(F.max("year")).first()[0]
    wh.recluster_dirty(spark, path, "year", [last - 1, last], ["o_orderdate", "o_orderkey"],
                       scratch(spark, "by-year-staging"))
    return spark.read.parquet(path).select("o_orderkey", "o_orderdate", "year")


@query("recluster_overlaps", """
    SELECT o_orderkey, o_orderdate, o_totalprice, 1 AS depth, TRUE AS sorted_kept FROM orders""")
def recluster_overlaps(spark, sf):
    """Orders to 1997 are loaded in order and the rest in two uploads as they come; the files that
    overlap are found by their ranges, and only these are sorted."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    tail = F.col("o_orderdate") >= F.expr("TIMESTAMP_NTZ '1997-01-01'")
    root = scratch(spark, "orders-clustered")
    first = manifest.create(spark, root, orders.filter(~tail), ["o_orderdate", "o_orderkey"])
    for k in range(2):
        old = manifest.append(spark, root, orders.filter(tail & (F.col("o_orderkey") % 2 == k)))
    new = manifest.recluster(spark, root)
    kept = first.names <= new.names and not (old.names - first.names) & new.names
    return manifest.read(spark, new).withColumns({
        "depth": F.lit(manifest.overlap_depth(spark, new)), "sorted_kept": F.lit(kept)})


@query("compact", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderstatus <> 'F'")
def compact(spark, sf):
    """Rows that a delete left behind in many small files are rewritten into few."""
    small, whole = scratch(spark, "small-files"), scratch(spark, "compacted")
    df = table(spark, sf, "orders").filter("o_orderstatus <> 'F'").select(
        "o_orderkey", "o_orderdate", "o_totalprice")
    df.repartition(2 * task_count(spark)).write.parquet(small)
    wh.compact(spark, small, whole)
    return spark.read.parquet(whole)


@query("compact_report", """
    SELECT TRUE AS had_files, TRUE AS fewer_files, count(*) AS "rows" FROM orders""")
def compact_report(spark, sf):
    small, whole = scratch(spark, "small-files"), scratch(spark, "compacted")
    table(spark, sf, "orders").repartition(2 * task_count(spark)).write.parquet(small)
    done = wh.compact(spark, small, whole)
    return spark.createDataFrame(
        [(done["files_before"] > 0, done["files_after"] < done["files_before"], done["rows"])],
        "had_files boolean, fewer_files boolean, rows long")


@query("analyze_table", """
    SELECT col_name, 0::BIGINT AS null_count, d > 0 AS counted FROM (
      SELECT 'c_custkey' AS col_name, count(DISTINCT c_custkey) AS d FROM customer
      UNION ALL SELECT 'c_nationkey', count(DISTINCT c_nationkey) FROM customer
      UNION ALL SELECT 'c_mktsegment', count(DISTINCT c_mktsegment) FROM customer)""")
def analyze_table(spark, sf):
    name = readers.unique_name("analyzed")
    df = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    sinks.sink_overwrite(df, name, scratch(spark, name))
    stats = wh.analyze_table(spark, name)  # distinct counts there are estimates
    return stats.select("col_name", "null_count", (F.col("distinct_count") > 0).alias("counted"))


@query("table_info", 'SELECT count(*) AS "rows", TRUE AS has_files FROM orders')
def table_info(spark, sf):
    info = wh.table_info(table(spark, sf, "orders"))
    return info.select("rows", ((F.col("files") > 0) & (F.col("bytes") > 0)).alias("has_files"))


@query("table_info_visible", """
    SELECT count(*) AS visible_rows, TRUE AS holds_replaced_rows FROM orders""")
def table_info_visible(spark, sf):
    """A file-wise table after an upsert: the replaced files hold rows that no reader sees."""
    orders, root = table(spark, sf, "orders"), scratch(spark, "orders-visible")
    manifest.create(spark, root, orders, ["o_orderkey"])
    manifest.upsert_files(spark, root, orders.filter("o_orderkey % 10 = 0"), ["o_orderkey"])
    info = manifest.table_info(spark, root)
    return info.select("visible_rows", (F.col("rows") > F.col("visible_rows"))
                       .alias("holds_replaced_rows"))


@query("load_dry_run", """
    SELECT c_custkey || '' AS row_id, 'segment' AS col_name, c_mktsegment AS value,
           'not a int' AS reason FROM customer
    UNION ALL SELECT c_custkey || '', 'name', c_name, 'not a date' FROM customer
    UNION ALL SELECT c_custkey || '', 'since', NULL, 'missing' FROM customer""")
def load_dry_run(spark, sf):
    """The customer file checked against a schema it does not fit."""
    path = scratch(spark, "dry-run")
    sinks.sink_csv(table(spark, sf, "customer"), path, header=False)
    text = spark.read.csv(path).withColumn("row_id", F.col("_c0"))
    return wh.load_dry_run(
        text, "id bigint, name date, nation int, balance double, segment int, since date not null")


@query("load_dry_run_lines", """
    SELECT c_custkey AS row_id, 'segment' AS col_name, c_mktsegment AS value, 'not a int' AS reason,
           TRUE AS on_its_line FROM customer WHERE c_custkey % 7 <> 0
    UNION ALL SELECT c_custkey, 'segment', NULL, 'record ends early', TRUE FROM customer
      WHERE c_custkey % 7 = 0
    UNION ALL SELECT c_custkey, NULL, 'more, ' || c_custkey, 'no such column', TRUE FROM customer
      WHERE c_custkey % 5 = 0 AND c_custkey % 7 <> 0""")
def load_dry_run_lines(spark, sf):
    """Customers as lines of which some have a cell too many and some end early, in any place."""
    text = lambda c: F.col(c).cast("string")
    cells = [text("c_custkey"), F.concat(F.lit('"'), "c_name", F.lit('"')), text("c_nationkey"),
             text("c_acctbal")]
    extra = F.when(F.col("c_custkey") % 5 == 0, F.concat(
        F.lit('"more, '), text("c_custkey"), F.lit('"')))
    short = F.concat_ws(",", *cells)
    line = F.when(F.col("c_custkey") % 7 == 0, short).otherwise(
        F.concat_ws(",", short, "c_mktsegment", extra))
    path = scratch(spark, "dry-run-lines")
    table(spark, sf, "customer").select(line.alias("value")).write.text(path)
    found = wh.load_dry_run_lines(
        spark, path, "id bigint, name string, nation int, balance double, segment int")
    known = lines.numbered_lines(spark, path).select(
        "file", "line_no", F.split("line", ",")[0].cast("long").alias("row_id"))
    return found.join(known, ["file", "line_no"], "left").select(
        "row_id", "col_name", "value", "reason", F.col("row_id").isNotNull().alias("on_its_line"))


@query("load_check", """
    SELECT 'region' AS table_name, count(*) AS row_count, 5::BIGINT AS expected, count(*) = 5 AS passed
      FROM region
    UNION ALL SELECT 'nation', count(*), 25, count(*) = 25 FROM nation
    UNION ALL SELECT 'lineitem', count(*), 1, count(*) = 1 FROM lineitem
    UNION ALL SELECT 'orders', count(*), 1, count(*) = 1 FROM orders""")
def load_check(spark, sf):
    wanted = {"region": 5, "nation": 25, "lineitem": 1, "orders": 1}
    return wh.load_check({n: (table(spark, sf, n), k) for n, k in wanted.items()})
