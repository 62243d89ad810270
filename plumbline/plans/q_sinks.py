"""Queries over the writers: each writes to a fresh folder and returns what it reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import relational
from plumbline.plans import config
from plumbline.plans.catalog import query
from plumbline.plans.derived import pair, with_pair
from plumbline.session import scratch, table
from plumbline.sources import manifest, readers, sinks


@query("sink_overwrite", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def sink_overwrite(spark, sf):
    df = table(spark, sf, "customer")
    name = readers.unique_name("over")
    path = scratch(spark, name)
    sinks.sink_overwrite(df.select("c_custkey", "c_acctbal"), name, path)
    sinks.sink_overwrite(df.select("c_custkey", "c_name", "c_mktsegment"), name, path)
    return spark.table(name)


@query("sink_replace_slice", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1.0 ELSE o_totalprice END
             AS o_totalprice, o_orderstatus
    FROM orders""")
def sink_replace_slice(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = scratch(spark, "slices")
    df.write.partitionBy("o_orderstatus").parquet(path)
    fixed = df.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1.0)
    sinks.sink_replace_slice(fixed, path, "o_orderstatus")
    return spark.read.schema(df.schema).parquet(path)


@query("sink_partitioned", "SELECT event_id, user_id, value, event_type FROM events")
def sink_partitioned(spark, sf):
    df = table(spark, sf, "events").select("event_id", "user_id", "value", "event_type")
    name = readers.unique_name("parted")
    sinks.sink_partitioned(df, name, "event_type", ["event_type", "user_id", "event_id"],
                           scratch(spark, name))
    return spark.table(name)


@query("sink_append", """
    SELECT 'customer' AS kind, c_custkey AS id, c_name AS name FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier""")
def sink_append(spark, sf):
    name = readers.unique_name("appended")
    path = scratch(spark, name)
    for kind, key, label in (("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name")):
        rows = table(spark, sf, kind).select(F.lit(kind).alias("kind"), F.col(key).alias("id"),
                                             F.col(label).alias("name"))
        sinks.sink_append(rows, name, path)
    return spark.table(name)


@query("sink_ctas", """
    SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey""")
def sink_ctas(spark, sf):
    name = readers.unique_name("made")
    rows = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    sinks.sink_overwrite(rows, name, scratch(spark, name))
    return spark.table(name)


@query("sink_view", with_pair("SELECT o_orderkey, o_totalprice FROM pair WHERE o_orderstatus IS NULL"))
def sink_view(spark, sf):
    name = readers.unique_name("pair_view")
    sinks.sink_view(pair(spark, sf)[1], name)
    return spark.sql(f"SELECT o_orderkey, o_totalprice FROM {name} WHERE o_orderstatus IS NULL")


@query("sink_csv", "SELECT p_partkey, p_name, p_size FROM part")
def sink_csv(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    path = scratch(spark, "part-out")
    sinks.sink_csv(df, path)
    return spark.read.schema(df.schema).csv(path, header=True)


@query("sink_hive_layout", """
    SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
           CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour
    FROM events""")
def sink_hive_layout(spark, sf):
    path = scratch(spark, "hive")
    sinks.sink_hive_layout(table(spark, sf, "events"), path, "ts")
    return spark.read.parquet(path).select("event_id", "year", "month", "day", "hour")


@query("sink_upsert", with_pair("""
    SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM pair p WHERE p.o_orderkey = o.o_orderkey)
    UNION ALL SELECT DISTINCT * FROM pair"""))
def sink_upsert(spark, sf):
    """The merged rows go to a new table, which then takes the place of the old one."""
    target, changed = pair(spark, sf)
    name = readers.unique_name("merged")
    sinks.sink_overwrite(target, name, scratch(spark, name))
    sinks.sink_upsert(spark, name, changed.distinct(), ["o_orderkey"], scratch(spark, name))
    return spark.table(name)


@query("sink_upsert_slices", with_pair("""
    SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM pair p WHERE p.o_orderkey = o.o_orderkey
                                               AND p.o_orderpriority = o.o_orderpriority)
                              OR o_orderpriority NOT LIKE '1%'
    UNION ALL SELECT DISTINCT * FROM pair WHERE o_orderpriority LIKE '1%'"""))
def sink_upsert_slices(spark, sf):
    """Changes to orders of one priority: only the slice that they name is read and written."""
    target, changed = pair(spark, sf)
    path = scratch(spark, "orders-slices")
    target.write.partitionBy("o_orderpriority").parquet(path)
    rows = changed.distinct().filter("o_orderpriority LIKE '1%'")
    sinks.sink_upsert_slices(spark, path, rows, ["o_orderkey", "o_orderpriority"], "o_orderpriority")
    return spark.read.schema(target.schema).parquet(path)


@query("sink_upsert_files", with_pair("""
    , new AS (SELECT DISTINCT * FROM pair WHERE o_orderkey % 1000 < 50 AND o_orderkey < (
                SELECT max(o_orderkey) / 4 FROM orders))
    SELECT *, TRUE AS others_kept FROM orders o
      WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.o_orderkey = o.o_orderkey)
    UNION ALL SELECT *, TRUE FROM new"""))
def sink_upsert_files(spark, sf):
    """Changes to keys of the first quarter: files without such a key keep their names, and there
    are some; files with one are gone."""
    target, changed = pair(spark, sf)
    root = scratch(spark, "orders-files")
    most = target.agg(F.max("o_orderkey")).first()[0]
    quarter = F.least(F.floor(F.col("o_orderkey") * 4 / most), F.lit(3))
    old = manifest.create(spark, root, target.filter(quarter == 0), ["o_orderkey"])
    for k in (1, 2, 3):
        old = manifest.append(spark, root, target.filter(quarter == k))
    top = most / 4
    rows = changed.distinct().filter(f"o_orderkey % 1000 < 50 AND o_orderkey < {top}")
    found = set(manifest.touched(spark, old, rows, ["o_orderkey"]))
    new = manifest.upsert_files(spark, root, rows, ["o_orderkey"])
    kept = old.names - found <= new.names and not found & new.names
    return manifest.read(spark, new).withColumn("others_kept", F.lit(kept))


@query("sink_swap_table", "SELECT s_suppkey, s_name FROM supplier")
def sink_swap_table(spark, sf):
    df = table(spark, sf, "supplier")
    old, new = readers.unique_name("swap_old"), readers.unique_name("swap_new")
    sinks.sink_overwrite(df.select("s_suppkey"), old, scratch(spark, old))
    sinks.sink_overwrite(df.select("s_suppkey", "s_name"), new, scratch(spark, new))
    sinks.sink_swap_table(spark, old, new)
    return spark.table(old)


@query("delete_where", """
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE NOT (o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'
               AND o_orderdate < TIMESTAMP '1998-01-01 00:00:00')""")
def delete_where(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return relational.delete_where(
        df, "o_orderdate >= TIMESTAMP_NTZ '1997-01-01' AND o_orderdate < TIMESTAMP_NTZ '1998-01-01'"
    )


# --- option rows, derived from customers: one small config per customer -------------------

CONFIG_SQL = """
    cfg AS (
      SELECT 'tbl_' || c_custkey AS left_tbl, 'src_' || c_custkey AS right_tbl, 'where' AS arg_name,
             'str' AS arg_dt, 'nation = ' || c_nationkey AS arg_val, 'u' || c_nationkey AS user_id
      FROM customer
      UNION ALL
      SELECT 'tbl_' || c_custkey, 'src_' || c_custkey, 'cfg_json', 'str',
             '{"keys":["' || c_mktsegment || '"],"note":"' || c_name || '"}', 'u' || c_nationkey
      FROM customer)
"""


def config_table(spark, sf):
    c = table(spark, sf, "customer")
    arg = lambda n, v: F.struct(F.lit(n).alias("arg_name"), F.lit("str").alias("arg_dt"),
                                v.alias("arg_val"))
    blob = F.concat(F.lit('{"keys":["'), F.col("c_mktsegment"), F.lit('"],"note":"'),
                    F.col("c_name"), F.lit('"}'))
    args = F.array(arg("where", F.concat(F.lit("nation = "), F.col("c_nationkey"))),
                   arg("cfg_json", blob))
    return c.select(
        F.concat(F.lit("tbl_"), F.col("c_custkey")).alias("left_tbl"),
        F.concat(F.lit("src_"), F.col("c_custkey")).alias("right_tbl"),
        F.inline(args),
        F.concat(F.lit("u"), F.col("c_nationkey")).alias("user_id"),
    ).select("left_tbl", "right_tbl", "arg_name", "arg_dt", "arg_val", "user_id")


@query("config_load", f"""
    WITH {CONFIG_SQL} SELECT arg_name, arg_dt, arg_val FROM cfg
    WHERE lower(left_tbl) = 'tbl_7' AND lower(user_id) =
          (SELECT 'u' || c_nationkey FROM customer WHERE c_custkey = 7)""")
def config_load(spark, sf):
    cfg = config_table(spark, sf)
    user = table(spark, sf, "customer").filter("c_custkey = 7").first().c_nationkey
    return config.config_rows(cfg, " TBL_7 ", f"U{user}")


@query("config_save", f"""
    WITH {CONFIG_SQL}, new AS (
      SELECT 'tbl_' || c_custkey AS left_tbl, 'src_' || c_custkey AS right_tbl,
             'where' AS arg_name, 'str' AS arg_dt, 'balance > 0' AS arg_val,
             'u' || c_nationkey AS user_id FROM customer WHERE c_acctbal > 0
      UNION ALL
      SELECT 'new_' || s_suppkey, 'src', 'keys', 'list', '["id"]', 'u' || s_nationkey FROM supplier)
    SELECT * FROM cfg c WHERE NOT EXISTS (
      SELECT 1 FROM new n WHERE n.left_tbl = c.left_tbl AND n.user_id = c.user_id
        AND n.arg_name = c.arg_name)
    UNION ALL SELECT * FROM new""")
def config_save(spark, sf):
    changed = table(spark, sf, "customer").filter("c_acctbal > 0").selectExpr(
        "concat('tbl_', c_custkey) AS left_tbl", "concat('src_', c_custkey) AS right_tbl",
        "'where' AS arg_name", "'str' AS arg_dt", "'balance > 0' AS arg_val",
        "concat('u', c_nationkey) AS user_id",
    )
    added = table(spark, sf, "supplier").selectExpr(
        "concat('new_', s_suppkey) AS left_tbl", "'src' AS right_tbl", "'keys' AS arg_name",
        "'list' AS arg_dt", "'[\"id\"]' AS arg_val", "concat('u', s_nationkey) AS user_id",
    )
    return config.config_save(config_table(spark, sf), changed.unionByName(added))


@query("config_json_to_rows", f"""
    WITH {CONFIG_SQL} SELECT * FROM cfg
    UNION ALL SELECT left_tbl, right_tbl, 'keys', 'list', CAST(json_extract(arg_val, '$.keys') AS VARCHAR),
                     user_id FROM cfg WHERE arg_name = 'cfg_json'
    UNION ALL SELECT left_tbl, right_tbl, 'note', 'str', json_extract_string(arg_val, '$.note'),
                     user_id FROM cfg WHERE arg_name = 'cfg_json'""")
def config_json_to_rows(spark, sf):
    return config.config_json_to_rows(config_table(spark, sf), ["keys", "note"])


@query("config_migrate", """
    WITH old AS (
      SELECT 'tbl_' || c_custkey AS left_tbl, 'src_' || c_custkey AS right_tbl,
             'u' || c_nationkey AS user_id,
             CASE WHEN c_acctbal > 0 THEN 'balance > 0' END AS w, c_mktsegment AS seg, c_name AS nm
      FROM customer)
    SELECT left_tbl, right_tbl, 'keys' AS arg_name, 'list' AS arg_dt,
           '["id","' || seg || '"]' AS arg_val, user_id FROM old
    UNION ALL SELECT left_tbl, right_tbl, 'where', 'str', w, user_id FROM old WHERE w IS NOT NULL
    UNION ALL SELECT left_tbl, right_tbl, 'exclude', 'list', '["' || nm || '"]', user_id FROM old
    UNION ALL SELECT left_tbl, right_tbl, 'cfg_json', 'str', '{"exclude":["' || nm || '"]}', user_id
              FROM old""")
def config_migrate(spark, sf):
    old = table(spark, sf, "customer").selectExpr(
        "concat('tbl_', c_custkey) AS left_tbl", "concat('src_', c_custkey) AS right_tbl",
        "concat('u', c_nationkey) AS user_id", "array('id', c_mktsegment) AS keys",
        "CASE WHEN c_acctbal > 0 THEN 'balance > 0' END AS where",
        "concat('{\"exclude\":[\"', c_name, '\"]}') AS cfg_json",
    )
    wide, long = readers.unique_name("cfg_wide"), readers.unique_name("cfg_long")
    sinks.sink_overwrite(old, wide, scratch(spark, wide))
    moved = config.config_migrate(spark.table(wide), ["keys", "where", "exclude"])
    sinks.sink_partitioned(moved, long, "user_id", ["user_id", "left_tbl", "arg_name"],
                           scratch(spark, long))
    sinks.sink_swap_table(spark, wide, long)
    return spark.table(wide)
