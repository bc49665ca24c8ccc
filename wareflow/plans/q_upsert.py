"""Driver queries for upsert, whole-table publish and keyed REPLACE.

Stored ("ods") and staging ("stg") sides come from the same table split by
date: the stored snapshot holds everything before a cut-off, the staging drop
re-extracts an overlapping later window with changed values. Both sides grow
with the table; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wareflow.operators.upsert import replace_into, upsert
from wareflow.plans.registry import query, table
from wareflow.session import scratch_path
from wareflow.sinks.files import publish_table

ODS_BEFORE = "2000-01-01"
STG_FROM = "1999-01-01"


def _orders_sides(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    ods = orders.where(F.col("o_orderdate") < F.lit(ODS_BEFORE).cast("timestamp_ntz"))
    stg = (orders.where(F.col("o_orderdate") >= F.lit(STG_FROM).cast("timestamp_ntz"))
           .withColumn("o_orderstatus", F.lit("F")))
    return stg, ods


UPSERT_ORDERS_SQL = f"""
WITH ods AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{ODS_BEFORE}'),
     stg AS (SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, o_totalprice,
                    o_orderdate, o_orderpriority, 1 AS present
             FROM orders WHERE o_orderdate >= TIMESTAMP '{STG_FROM}')
SELECT CASE WHEN s.present IS NOT NULL THEN s.o_orderkey ELSE o.o_orderkey END AS o_orderkey,
       CASE WHEN s.present IS NOT NULL THEN s.o_custkey ELSE o.o_custkey END AS o_custkey,
       CASE WHEN s.present IS NOT NULL THEN s.o_orderstatus ELSE o.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.present IS NOT NULL THEN s.o_totalprice ELSE o.o_totalprice END AS o_totalprice,
       CASE WHEN s.present IS NOT NULL THEN s.o_orderdate ELSE o.o_orderdate END AS o_orderdate,
       CASE WHEN s.present IS NOT NULL THEN s.o_orderpriority ELSE o.o_orderpriority END AS o_orderpriority
FROM stg s FULL OUTER JOIN ods o ON s.o_orderkey IS NOT DISTINCT FROM o.o_orderkey
"""


@query("upsert_join", UPSERT_ORDERS_SQL)
def upsert_join(spark, sf_dir):
    """Full-outer upsert, staging row wins whole."""
    stg, ods = _orders_sides(spark, sf_dir)
    return upsert(stg, ods, ["o_orderkey"], mode="join")


@query("upsert_replace", f"""
WITH ods AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{ODS_BEFORE}'),
     stg AS (SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, o_totalprice,
                    o_orderdate, o_orderpriority
             FROM orders WHERE o_orderdate >= TIMESTAMP '{STG_FROM}')
SELECT * FROM ods o WHERE NOT EXISTS (SELECT 1 FROM stg s WHERE s.o_orderkey = o.o_orderkey)
UNION ALL SELECT * FROM stg
""")
def upsert_replace(spark, sf_dir):
    """Anti join + union (same result as join mode when stored keys are unique)."""
    stg, ods = _orders_sides(spark, sf_dir)
    return upsert(stg, ods, ["o_orderkey"], mode="replace")


LINE_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, "
             "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")


@query("upsert_fanout", f"""
WITH ods AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{ODS_BEFORE}'),
     stg AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
                    l_extendedprice, l_discount, l_tax, l_returnflag, 'F' AS l_linestatus,
                    l_shipdate, 1 AS present
             FROM lineitem WHERE l_shipdate >= TIMESTAMP '{STG_FROM}')
SELECT {', '.join(f"CASE WHEN s.present IS NOT NULL THEN s.{c} ELSE o.{c} END AS {c}"
                  for c in LINE_COLS.split(', '))}
FROM stg s FULL OUTER JOIN ods o ON s.l_orderkey IS NOT DISTINCT FROM o.l_orderkey
""")
def upsert_fanout(spark, sf_dir):
    """Non-unique key (l_orderkey): staging rows repeat once per stored match."""
    li = table(spark, sf_dir, "lineitem")
    ods = li.where(F.col("l_shipdate") < F.lit(ODS_BEFORE).cast("timestamp_ntz"))
    stg = (li.where(F.col("l_shipdate") >= F.lit(STG_FROM).cast("timestamp_ntz"))
           .withColumn("l_linestatus", F.lit("F")))
    return upsert(stg, ods, ["l_orderkey"], mode="join")


def _composite_side(orders):
    return orders.select(
        F.col("o_custkey").cast("string").alias("k_cust"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("k_prio"),
        "o_orderkey", "o_orderstatus", "o_totalprice")


@query("upsert_composite", f"""
WITH base AS (SELECT CAST(o_custkey AS VARCHAR) AS k_cust,
                     NULLIF(o_orderpriority, '5-LOW') AS k_prio,
                     o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders),
     ods AS (SELECT * FROM base WHERE o_orderdate < TIMESTAMP '{ODS_BEFORE}'),
     stg AS (SELECT k_cust, CASE WHEN k_prio IS NULL THEN '' ELSE k_prio END AS k_prio,
                    o_orderkey, 'F' AS o_orderstatus, o_totalprice, 1 AS present
             FROM base WHERE o_orderdate >= TIMESTAMP '{STG_FROM}')
SELECT {', '.join(f"CASE WHEN s.present IS NOT NULL THEN s.{c} ELSE o.{c} END AS {c}"
                  for c in ['k_cust', 'k_prio', 'o_orderkey', 'o_orderstatus', 'o_totalprice'])}
FROM stg s FULL OUTER JOIN ods o
  ON COALESCE(s.k_cust, '') = COALESCE(o.k_cust, '')
 AND COALESCE(s.k_prio, '') = COALESCE(o.k_prio, '')
""")
def upsert_composite(spark, sf_dir):
    """Two string key columns; NULL on one side matches "" on the other."""
    orders = table(spark, sf_dir, "orders")
    ods = _composite_side(orders.where(
        F.col("o_orderdate") < F.lit(ODS_BEFORE).cast("timestamp_ntz")))
    stg = (_composite_side(orders.where(
        F.col("o_orderdate") >= F.lit(STG_FROM).cast("timestamp_ntz")))
        .withColumn("k_prio", F.coalesce(F.col("k_prio"), F.lit("")))
        .withColumn("o_orderstatus", F.lit("F")))
    return upsert(stg, ods, ["k_cust", "k_prio"], mode="join")


@query("upsert_publish", UPSERT_ORDERS_SQL)
def upsert_publish(spark, sf_dir):
    """Upsert into a stored table that is also the job's input, then read it back."""
    stg, ods = _orders_sides(spark, sf_dir)
    path = scratch_path(spark, "ods_orders")
    ods.write.parquet(path)
    stored = spark.read.parquet(path)
    publish_table(upsert(stg, stored, ["o_orderkey"]), path)
    return spark.read.parquet(path)


@query("replace_into", """
WITH batch AS (
  SELECT o.o_custkey AS c_custkey, c.c_name, c.c_nationkey, o.o_totalprice AS c_acctbal,
         c.c_mktsegment,
         ROW_NUMBER() OVER (PARTITION BY o.o_custkey
                            ORDER BY o.o_orderdate DESC, o.o_orderkey DESC) AS rn
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey),
last AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM batch WHERE rn = 1)
SELECT * FROM customer c WHERE NOT EXISTS (SELECT 1 FROM last l WHERE l.c_custkey = c.c_custkey)
UNION ALL SELECT * FROM last
""")
def replace_into_q(spark, sf_dir):
    """Customer rows replaced by a batch with repeated keys (latest order wins)."""
    cust = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders")
    batch = (orders.join(cust, cust.c_custkey == orders.o_custkey)
             .select(orders.o_custkey.alias("c_custkey"), "c_name", "c_nationkey",
                     orders.o_totalprice.alias("c_acctbal"), "c_mktsegment",
                     "o_orderdate", "o_orderkey"))
    return replace_into(cust, batch, ["c_custkey"], order_by=["o_orderdate", "o_orderkey"])
