"""Driver queries for sources and sinks.

Each sink query writes below the session's shared checkpoint folder and
returns what is read back, so the oracle checks stored data.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wareflow.operators.partition import parse_prt_path, with_prt_path
from wareflow.plans.registry import query, table
from wareflow.session import scratch_path
from wareflow.sinks.catalog import ensure_external_table, repair
from wareflow.sinks.files import (export_parts, publish_partitions, write_delimited,
                                  write_partitioned, write_staging_csv)
from wareflow.sources.text import (check_headers, read_delimited, read_lines,
                                   read_bound, read_staging)

CUSTOMER_TEXT_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
       CAST(c_nationkey AS VARCHAR) AS c_nationkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal,
       c_mktsegment FROM customer
"""


@query("scan_lines", """
SELECT concat_ws(chr(1), CAST(c_custkey AS VARCHAR), c_name, CAST(c_acctbal AS VARCHAR)) AS value
FROM customer
""")
def scan_lines(spark, sf_dir):
    """Lines of a two-level folder tree, read recursively."""
    cust = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment", "c_nationkey")
    path = scratch_path(spark, "lines")
    write_delimited(cust, path, parts=["c_mktsegment", "c_nationkey"])
    return read_lines(spark, path)


@query("staging_csv", CUSTOMER_TEXT_SQL)
def staging_csv(spark, sf_dir):
    """Staging CSV (header per file, no quoting) read back as all strings."""
    path = scratch_path(spark, "stg_customer")
    write_staging_csv(table(spark, sf_dir, "customer").repartition(4), path)
    return read_staging(spark, path)


@query("header_check", """
SELECT 'same' AS drop_name, count(DISTINCT c_mktsegment) AS n_files, 1::BIGINT AS n_headers, true AS header_ok FROM customer
UNION ALL
SELECT 'mixed' AS drop_name, count(DISTINCT c_mktsegment) AS n_files,
       count(DISTINCT CASE WHEN c_mktsegment LIKE '%U%' THEN c_mktsegment ELSE '' END) AS n_headers,
       count(DISTINCT CASE WHEN c_mktsegment LIKE '%U%' THEN c_mktsegment ELSE '' END) = 1 AS header_ok FROM customer
""")
def header_check(spark, sf_dir):
    """Files and distinct headers per staging drop: one file a segment; in one drop the
    segments with a U in their name call the name column after themselves."""
    cust = table(spark, sf_dir, "customer")
    segments = [r[0] for r in cust.select("c_mktsegment").distinct().orderBy("c_mktsegment").collect()]
    out = None
    for name in ("same", "mixed"):
        path = scratch_path(spark, f"stg_{name}")
        for i, segment in enumerate(segments):
            part = cust.where(F.col("c_mktsegment") == segment)
            if name == "mixed" and "U" in segment:
                part = part.withColumnRenamed("c_name", f"name_{segment}")
            write_staging_csv(part.coalesce(1), f"{path}/{i}")
        checked = check_headers(spark, path).select(
            F.lit(name).alias("drop_name"), "n_files", "n_headers",
            (F.col("n_headers") == 1).alias("header_ok"))
        out = checked if out is None else out.unionByName(checked)
    return out


@query("bind_header", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, unnest(['c_name', 'NA_2', 'c_custkey']) AS name,
       unnest([c_name, CAST(c_nationkey AS VARCHAR), CAST(c_custkey AS VARCHAR)]) AS value
FROM customer WHERE c_mktsegment < 'F'
UNION ALL
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, unnest(['c_custkey', 'c_acctbal', 'c_mktsegment', 'spare']) AS name,
       unnest([CAST(c_custkey AS VARCHAR), CAST(c_acctbal AS VARCHAR), c_mktsegment, NULL]) AS value
FROM customer WHERE c_mktsegment >= 'F'
""")
def bind_header(spark, sf_dir):
    """Drops of unlike columns: each file's header bound to its fields by position, at run time."""
    cust = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "stg_bound")
    write_staging_csv(cust.where("c_mktsegment < 'F'").select("c_name", F.col("c_nationkey").alias(" "), "c_custkey"), f"{path}/a")
    # One file a nation; the last column of its header has no fields.
    late = cust.where("c_mktsegment >= 'F'")
    heads = late.select("c_nationkey").distinct().select(
        "c_nationkey", F.lit(0).alias("at"), F.lit("c_custkey,c_acctbal,c_mktsegment,spare").alias("value"))
    lines = late.select("c_nationkey", F.lit(1).alias("at"), F.concat_ws(",", "c_custkey", "c_acctbal", "c_mktsegment").alias("value"))
    (heads.unionByName(lines).repartition("c_nationkey").sortWithinPartitions("c_nationkey", "at")
     .select("value", "c_nationkey").write.partitionBy("c_nationkey").text(f"{path}/b"))
    rows = read_bound(spark, path)
    key = F.element_at(F.filter("fields", lambda f: f["name"] == "c_custkey"), 1)["value"]
    return (rows.select(key.alias("c_custkey"), F.explode("fields").alias("f"))
            .select("c_custkey", F.col("f.name").alias("name"), F.col("f.value").alias("value")))


@query("header_fill", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name AS NA_2,
       CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment AS NA_4 FROM customer
""")
def header_fill(spark, sf_dir):
    """Blank header names become NA_<position>."""
    cust = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_name").alias(" "), "c_nationkey",
        F.col("c_mktsegment").alias("  "))
    path = scratch_path(spark, "stg_blank")
    write_staging_csv(cust, path)
    return read_staging(spark, path)


@query("ctrl_a_rows", """
SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name,
       CAST(s_nationkey AS VARCHAR) AS s_nationkey, CAST(s_acctbal AS VARCHAR) AS s_acctbal
FROM supplier
""")
def ctrl_a_rows(spark, sf_dir):
    """Headerless \\x01 rows out and back in with positional names."""
    supp = table(spark, sf_dir, "supplier")
    path = scratch_path(spark, "ctrl_a")
    write_delimited(supp, path)
    return read_delimited(spark, path, supp.columns)


def orders_prt():
    return [("o_year", F.date_format("o_orderdate", "yyyy")),
            ("o_status", F.col("o_orderstatus"))]


@query("partition_write", """
SELECT 'o_year=' || strftime(o_orderdate, '%Y') || '/o_status=' || o_orderstatus AS prt_path,
       o_orderkey, o_custkey, o_totalprice, o_orderpriority,
       strftime(o_orderdate, '%Y') AS o_year, o_orderstatus AS o_status
FROM orders
""")
def partition_write(spark, sf_dir):
    """Two-level name=value folders from prt_path, read back by discovery."""
    orders = table(spark, sf_dir, "orders")
    df = with_prt_path(orders, orders_prt()).select(
        "prt_path", "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    routed = parse_prt_path(df, ["o_year", "o_status"])
    path = scratch_path(spark, "prt_orders")
    write_partitioned(routed, path, ["o_year", "o_status"])
    return spark.read.parquet(path)


@query("prt_path_parse", """
SELECT 'o_year=' || strftime(o_orderdate, '%Y') || '/o_status=' || o_orderstatus AS prt_path,
       CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority,
       strftime(o_orderdate, '%Y') AS o_year, o_orderstatus AS o_status
FROM orders
""")
def prt_path_parse(spark, sf_dir):
    """prt_path stored as the first text field, parsed back to its levels."""
    orders = table(spark, sf_dir, "orders")
    df = with_prt_path(orders, orders_prt()).select("prt_path", "o_orderkey", "o_orderpriority")
    path = scratch_path(spark, "prt_text")
    write_delimited(df, path)
    back = read_delimited(spark, path, df.columns)
    return parse_prt_path(back, ["o_year", "o_status"])


@query("publish_dynamic", """
SELECT event_id, user_id, value, event_type FROM events WHERE event_type <> 'click'
UNION ALL
SELECT event_id, user_id, value * 2 AS value, event_type FROM events WHERE event_type = 'click'
""")
def publish_dynamic(spark, sf_dir):
    """Republishing one partition leaves every other partition untouched."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "value", "event_type")
    path = scratch_path(spark, "events_by_type")
    publish_partitions(ev, path, ["event_type"])
    fresh = ev.where(F.col("event_type") == "click").withColumn("value", F.col("value") * 2)
    publish_partitions(fresh, path, ["event_type"])
    return spark.read.parquet(path)


@query("external_table", """
SELECT 0::BIGINT AS n_before, count(*) AS n_after, count(DISTINCT event_type) AS n_partitions
FROM events
""")
def external_table(spark, sf_dir):
    """Create an all-string partitioned table over written data, then repair it."""
    ev = table(spark, sf_dir, "events")
    text = ev.select(*[F.col(c).cast("string") for c in ev.columns])
    path = scratch_path(spark, "ext_events")
    data_cols = [c for c in ev.columns if c != "event_type"]
    write_partitioned(text, path, ["event_type"])
    name = "wf_ext_" + path.rsplit("-", 1)[-1]
    ensure_external_table(spark, name, data_cols, ["event_type"], path)
    before = spark.table(name).count()
    repair(spark, name)
    after = spark.table(name).agg(F.count(F.lit(1)).alias("n_after"),
                                  F.count_distinct("event_type").alias("n_partitions"))
    return after.select(F.lit(before).cast("bigint").alias("n_before"), "n_after",
                        "n_partitions")


@query("export_single", """
SELECT CAST(event_id AS VARCHAR) AS event_id,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, CAST(user_id AS VARCHAR) AS user_id,
       event_type, CAST(value AS VARCHAR) AS value, props
FROM events
""")
def export_single(spark, sf_dir):
    """Hand-off export: one folder of headerless part files, read back."""
    ev = table(spark, sf_dir, "events").withColumn(
        "ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    path = scratch_path(spark, "export")
    export_parts(ev, path, sep="\t")
    return read_delimited(spark, path, ev.columns, sep="\t")
