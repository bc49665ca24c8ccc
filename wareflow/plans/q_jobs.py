"""Driver queries for the composite jobs C1-C5 (C6 is ``kpi_job`` in q_kpi).

Each query lays out a small warehouse under the shared scratch folder
(``stg.db``, ``ods.db``, ``model.db``, ``4ml.db``) from the tables, runs the
job as a user would, and returns the table the job published.
"""

from __future__ import annotations

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareflow.functions.spec import resolve
from wareflow.operators.partition import with_prt_path
from wareflow.plans import jobs
from wareflow.plans.registry import query, table
from wareflow.session import scratch_path
from wareflow.sinks.files import move_folder, write_delimited, write_staging_csv
from wareflow.sinks.layouts import read_feature_table
from wareflow.sources.text import read_feature_json, read_lines

ODS_BEFORE, STG_FROM = "2000-01-01", "1999-01-01"


def _orders_text(orders):
    return orders.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"), "o_orderstatus",
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"),
        "o_orderpriority")


ORDERS_TEXT_COLS = """CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
  {status} AS o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority"""


@query("merge_job", f"""
WITH ods AS (SELECT {ORDERS_TEXT_COLS.format(status='o_orderstatus')} FROM orders
             WHERE o_orderdate < TIMESTAMP '{ODS_BEFORE}'),
     stg AS (SELECT {ORDERS_TEXT_COLS.format(status="'F'")}, 1 AS present FROM orders
             WHERE o_orderdate >= TIMESTAMP '{STG_FROM}')
SELECT {', '.join(f"CASE WHEN s.present IS NOT NULL THEN s.{c} ELSE o.{c} END AS {c}"
                  for c in ['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice',
                            'o_orderdate', 'o_orderpriority'])}
FROM stg s FULL OUTER JOIN ods o ON s.o_orderkey = o.o_orderkey
""")
def merge_job_q(spark, sf_dir):
    """Two staging drops merged into the stored table on key position 0."""
    root = scratch_path(spark, "wh_merge")
    orders = table(spark, sf_dir, "orders")
    ts = F.lit(ODS_BEFORE).cast("timestamp_ntz")
    stg_path = resolve(root, "stg.d_orders")
    name = "ods.d_orders_" + root.rsplit("-", 1)[-1]
    write_staging_csv(_orders_text(orders.where(F.col("o_orderdate") < ts)), stg_path)
    jobs.merge_job(spark, root, "d_orders", [[":o_orderkey", 0]], catalog_name=name)
    later = orders.where(F.col("o_orderdate") >= F.lit(STG_FROM).cast("timestamp_ntz"))
    write_staging_csv(_orders_text(later).withColumn("o_orderstatus", F.lit("F")), stg_path)
    jobs.merge_job(spark, root, "d_orders", [[":o_orderkey", 0]], catalog_name=name)
    return spark.table(name)


@query("partition_job", """
SELECT 'p_type=' || event_type AS prt_path, CAST(event_id AS VARCHAR) AS event_id,
       CAST(user_id AS VARCHAR) AS user_id, event_type,
       CASE WHEN event_type = 'click' THEN 'republished' ELSE props END AS props,
       event_type AS p_type
FROM events
""")
def partition_job_q(spark, sf_dir):
    """Staging drops -> partitioned table; a later drop replaces only its partitions."""
    root = scratch_path(spark, "wh_prt")
    ev = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"), "event_type",
        F.regexp_replace("props", ",", ";").alias("props"))
    stg_path = resolve(root, "stg.d_events")
    name = "ods.d_events_" + root.rsplit("-", 1)[-1]
    spec = [[":p_type", 2]]
    write_staging_csv(ev, stg_path)
    jobs.partition_job(spark, root, "d_events", spec, catalog_name=name)
    clicks = ev.where(F.col("event_type") == "click").withColumn("props", F.lit("republished"))
    write_staging_csv(clicks, stg_path)
    jobs.partition_job(spark, root, "d_events", spec, catalog_name=name)
    return spark.table(name)


@query("merge_recover", f"""
SELECT {ORDERS_TEXT_COLS.format(status="'F'")} FROM orders WHERE o_orderdate >= TIMESTAMP '{STG_FROM}'
UNION ALL
SELECT {ORDERS_TEXT_COLS.format(status='o_orderstatus')} FROM orders WHERE o_orderdate < TIMESTAMP '{STG_FROM}'
""")
def merge_recover_q(spark, sf_dir):
    """A merge into a table that a dead driver left under its retired name, between the two renames of a swap."""
    root = scratch_path(spark, "wh_recover")
    orders = table(spark, sf_dir, "orders")
    stg_path, ods_path = resolve(root, "stg.d_orders"), resolve(root, "ods.d_orders")
    name = "ods.d_recover_" + root.rsplit("-", 1)[-1]
    write_staging_csv(_orders_text(orders), stg_path)
    jobs.merge_job(spark, root, "d_orders", [[":o_orderkey", 0]], catalog_name=name)
    move_folder(spark, ods_path, f"{ods_path}__retired_dead")
    later = orders.where(F.col("o_orderdate") >= F.lit(STG_FROM).cast("timestamp_ntz"))
    write_staging_csv(_orders_text(later).withColumn("o_orderstatus", F.lit("F")), stg_path)
    jobs.merge_job(spark, root, "d_orders", [[":o_orderkey", 0]], catalog_name=name)
    return spark.table(name)


@query("partition_slash", """
SELECT 'p_mix=' || o_orderstatus || '/' || o_orderpriority || '=?' AS prt_path, CAST(o_orderkey AS VARCHAR) AS o_orderkey,
       o_orderstatus || '/' || o_orderpriority || '=?' AS mix, o_orderstatus || '/' || o_orderpriority || '=?' AS p_mix
FROM orders
""")
def partition_slash_q(spark, sf_dir):
    """Partition values that hold the path's own marks: a slash and an equals sign."""
    root = scratch_path(spark, "wh_slash")
    mix = F.concat("o_orderstatus", F.lit("/"), "o_orderpriority", F.lit("=?"))
    write_staging_csv(table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"), mix.alias("mix")),
                      resolve(root, "stg.d_orders"))
    name = "ods.d_slash_" + root.rsplit("-", 1)[-1]
    jobs.partition_job(spark, root, "d_orders", [[":p_mix", 1]], catalog_name=name)
    return spark.table(name)


MODEL_COLUMNS = ["'prt_path", "l_orderkey", "l_linenumber", "l_quantity",
                 "_l_extendedprice", "_l_tax", "'l_returnflag"]
MODEL_EXPRS = [(":unit_price", ":l_extendedprice / :l_quantity"),
               (":dear", ":unit_price > 1500 && :l_returnflag != 'R'"),
               (":taxed", ":l_tax > 0.03 || :dear")]


@query("derive_job", """
SELECT 'ship_year=' || strftime(l_shipdate, '%Y') AS prt_path,
       CAST(l_orderkey AS DOUBLE) AS l_orderkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber,
       CAST(l_quantity AS DOUBLE) AS l_quantity, l_returnflag,
       l_extendedprice / l_quantity AS unit_price,
       (l_extendedprice / l_quantity > 1500 AND l_returnflag <> 'R') AS dear,
       (l_tax > 0.03 OR (l_extendedprice / l_quantity > 1500 AND l_returnflag <> 'R')) AS taxed,
       strftime(l_shipdate, '%Y') AS ship_year
FROM lineitem
""")
def derive_job_q(spark, sf_dir):
    """\\x01 model rows (prt_path first) -> typed, derived -> JSON by partition."""
    root = scratch_path(spark, "wh_derive")
    li = table(spark, sf_dir, "lineitem")
    model = with_prt_path(li, [("ship_year", F.date_format("l_shipdate", "yyyy"))]).select(
        "prt_path", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax",
        "l_returnflag")
    write_delimited(model, resolve(root, "model.d_lineitem"))
    out = jobs.derive_job(spark, root, "model.d_lineitem", "4ml.flags.d_lineitem",
                          MODEL_COLUMNS, MODEL_EXPRS)
    schema = T.StructType([
        T.StructField("prt_path", T.StringType()), T.StructField("l_orderkey", T.DoubleType()),
        T.StructField("l_linenumber", T.DoubleType()), T.StructField("l_quantity", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()), T.StructField("unit_price", T.DoubleType()),
        T.StructField("dear", T.BooleanType()), T.StructField("taxed", T.BooleanType()),
        T.StructField("ship_year", T.StringType())])
    return read_feature_json(spark, out, schema)


@query("derive_empty", """
SELECT CAST(p_partkey AS DOUBLE) AS p_partkey, p_size >= 25 AS large, p_brand
FROM part
""")
def derive_empty_q(spark, sf_dir):
    """An empty source replaces nothing: the partitions of the run before stay."""
    root = scratch_path(spark, "wh_empty")
    model = with_prt_path(table(spark, sf_dir, "part"), [("p_brand", F.col("p_brand"))]).select("prt_path", "p_partkey", "p_size")
    columns, exprs = ["'_prt_path", "p_partkey", "_p_size"], [(":large", ":p_size >= 25")]
    for rows in (model, model.where("p_partkey < 0")):
        write_delimited(rows, resolve(root, "model.d_part"))
        out = jobs.derive_job(spark, root, "model.d_part", "4ml.empty.d_part", columns, exprs)
    schema = T.StructType([T.StructField("p_partkey", T.DoubleType()), T.StructField("large", T.BooleanType())])
    return read_feature_table(spark, out, schema)


FEATURE_CONFIG = {
    "classId": "cls1",
    "data_sources": {
        "d_orders": {
            "column_items": [
                {"data_item": "o_orderkey", "data_type": "number"},
                {"data_item": "o_orderstatus", "data_type": "string"},
                {"data_item": "o_totalprice", "data_type": "number"},
                {"data_item": "o_orderpriority", "data_type": "string"},
                {"data_item": "o_custkey", "data_type": "number"}],
            "driven_items": [
                {"data_item": "o_totalprice", "data_type": "number"},
                {"data_item": "big", "data_type": "boolean", "expr": ":o_totalprice > 300000"},
                {"data_item": "o_orderpriority", "data_type": "string"}],
            "target_items": [
                {"data_item": "o_orderstatus", "data_type": "string"},
                {"data_item": "late", "data_type": "boolean",
                 "expr": ":o_orderstatus == 'F' || :big"}]}}}


def _feature_model(spark, sf_dir, root):
    orders = table(spark, sf_dir, "orders")
    model = with_prt_path(orders, [("o_year", F.date_format("o_orderdate", "yyyy"))]).select(
        "prt_path", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_custkey")
    write_delimited(model, resolve(root, "model.d_orders"))


FEATURE_JOB_SQL = """
SELECT 'o_year=' || strftime(o_orderdate, '%Y') AS prt_path,
       o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice, o_orderpriority,
       o_totalprice > 300000 AS big, (o_orderstatus = 'F' OR o_totalprice > 300000) AS late,
       strftime(o_orderdate, '%Y') AS o_year
FROM orders
"""

FEATURE_SCHEMA = T.StructType([
    T.StructField("prt_path", T.StringType()), T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderpriority", T.StringType()), T.StructField("big", T.BooleanType()),
    T.StructField("late", T.BooleanType()), T.StructField("o_year", T.StringType())])


@query("feature_job", FEATURE_JOB_SQL)
def feature_job_q(spark, sf_dir):
    """Feature config -> column spec (unused items hidden) + expressions -> 4ml JSON."""
    root = scratch_path(spark, "wh_feature")
    _feature_model(spark, sf_dir, root)
    jobs.feature_job(spark, root, json.dumps(FEATURE_CONFIG))
    return read_feature_json(spark, resolve(root, "4ml.cls1.d_orders"), FEATURE_SCHEMA)


ROLE_JOB_ID = "wh-cls1_19950101_20010801_roleJob"
ROLE_LINES = ["TargetCol,o_orderstatus,string", "InputCol,o_totalprice,number",
              "InputCol,o_orderpriority,string", "InputCol,big,boolean", "TargetCol,late,boolean",
              "PredStartDate,19950101,Date", "PredEndDate,20010801,Date",
              "InputDataPath,/handoff/in/cls1/d_orders/data.csv,string",
              "OutDataPath,/handoff/out/cls1/data.csv,string"]


@query("role_job", f"""
SELECT f.*, 'class_id=cls1/source=d_orders' AS role_path, {len(ROLE_LINES)}::BIGINT AS role_lines,
       '{chr(10).join(ROLE_LINES) + chr(10)}' AS role_file
FROM ({FEATURE_JOB_SQL}) f
""")
def role_job_q(spark, sf_dir):
    """Feature data exported for hand-off, read back beside the role file written for its source."""
    root = scratch_path(spark, "wh_role")
    _feature_model(spark, sf_dir, root)
    jobs.feature_job(spark, root, json.dumps(FEATURE_CONFIG))
    data_root, conf = f"{root}/var/handoff", f"{root}/var/conf/{ROLE_JOB_ID}"
    jobs.role_job(spark, root, ROLE_JOB_ID, json.dumps(FEATURE_CONFIG), data_root, conf)
    handed = read_lines(spark, f"{data_root}/in/cls1/d_orders")
    parsed = handed.select(F.from_json("value", FEATURE_SCHEMA).alias("r")).select("r.*")
    # The partition level is a folder name, not part of each JSON record.
    data = parsed.withColumn("o_year", F.regexp_extract("prt_path", "o_year=([^/]*)", 1))
    files = spark.read.text(conf, wholetext=True, recursiveFileLookup=True)
    # The scratch folder's name changes with each run; the rest of the paths is compared.
    text = F.replace("value", F.lit(data_root), F.lit("/handoff"))
    roles = files.select(F.regexp_extract("_metadata.file_path", "class_id=[^/]*/source=[^/]*", 0).alias("role_path"),
                         (F.size(F.split("value", "\n")) - 1).cast("bigint").alias("role_lines"), text.alias("role_file"))
    return data.join(F.broadcast(roles), F.col("role_path") == F.lit("class_id=cls1/source=d_orders"))   # one file a source


STREAMED = """
SELECT 'p_type=' || event_type AS prt_path, CAST(event_id AS VARCHAR) AS event_id,
       CAST(user_id AS VARCHAR) AS user_id, event_type, {props} AS props, event_type AS p_type
FROM events {where}
"""


def _stream_events(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"), "event_type",
        F.regexp_replace("props", ",", ";").alias("props"))


@query("stream_ingest", STREAMED.format(props="props", where="") + "UNION ALL"
       + STREAMED.format(props="'again'", where="WHERE event_type = 'click'"))
def stream_ingest_q(spark, sf_dir):
    """Two staging drops, each picked up by one run of the incremental stream; a later drop adds its rows
    to the partitions that it names."""
    from wareflow.streaming.ingest import ingest_partitions
    root = scratch_path(spark, "wh_stream")
    ev = _stream_events(spark, sf_dir)
    drops, target, ckpt = resolve(root, "stg.d_events"), resolve(root, "ods.d_events"), f"{root}/_checkpoint"
    spec = [[":p_type", 2]]
    write_staging_csv(ev, f"{drops}/drop=1")
    ingest_partitions(spark, f"{drops}/*", f"{drops}/drop=1", target, spec, ckpt)
    clicks = ev.where(F.col("event_type") == "click").withColumn("props", F.lit("again"))
    write_staging_csv(clicks, f"{drops}/drop=2")
    ingest_partitions(spark, f"{drops}/*", f"{drops}/drop=1", target, spec, ckpt)
    return spark.read.parquet(target)


@query("stream_ingest_files", STREAMED.format(props="props", where=""))
def stream_ingest_files_q(spark, sf_dir):
    """The same table whatever the split: three drops that share partitions, in two runs, one file a trigger
    in the second."""
    from wareflow.streaming.ingest import ingest_partitions
    root = scratch_path(spark, "wh_files")
    ev = _stream_events(spark, sf_dir)
    drops, target, ckpt = resolve(root, "stg.d_events"), resolve(root, "ods.d_events"), f"{root}/_checkpoint"
    third = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for i in range(3):
        write_staging_csv(ev.where(third == i), f"{drops}/drop={i}")
        if i != 1:
            ingest_partitions(spark, f"{drops}/*", f"{drops}/drop=0", target, [[":p_type", 2]], ckpt,
                              max_files_per_trigger=1 if i else None)
    return spark.read.parquet(target)


@query("derive_layouts", """
SELECT CAST(o_orderkey AS DOUBLE) AS o_orderkey, CAST(o_totalprice AS DOUBLE) * 2 AS doubled,
       CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y') END AS o_year,
       CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS o_priority,
       CASE WHEN o_orderstatus = 'P' THEN o_orderstatus END AS o_status
FROM orders
""")
def derive_layouts_q(spark, sf_dir):
    """Rows whose prt_path names different levels, by status, over two runs; read back as one table."""
    root = scratch_path(spark, "wh_layouts")
    orders = table(spark, sf_dir, "orders")
    year = ("o_year", F.date_format("o_orderdate", "yyyy"))
    spec = {"F": [year], "O": [year, ("o_priority", F.col("o_orderpriority"))], "P": [("o_status", F.col("o_orderstatus"))]}
    target = "4ml.layouts.d_orders"
    for run in (["F"], ["O", "P"]):                # the first run's levels are the table's home layout
        rows = None
        for status in run:
            part = with_prt_path(orders.where(F.col("o_orderstatus") == status), spec[status]).select(
                "prt_path", "o_orderkey", "o_totalprice")
            rows = part if rows is None else rows.unionByName(part)
        source = f"model.d_orders_{''.join(run).lower()}"
        write_delimited(rows, resolve(root, source))
        jobs.derive_job(spark, root, source, target, ["'_prt_path", "o_orderkey", "_o_totalprice"],
                        [(":doubled", ":o_totalprice * 2")])
    schema = T.StructType([T.StructField("o_orderkey", T.DoubleType()), T.StructField("doubled", T.DoubleType())])
    return read_feature_table(spark, resolve(root, target), schema)


PART_COLUMNS = ["p_partkey", "'p_name", "'p_brand", "'p_type", "p_size", "p_retailprice"]


@query("derive_passthrough", """
SELECT CAST(p_partkey AS DOUBLE) AS p_partkey, p_name, p_brand, p_type,
       CAST(p_size AS DOUBLE) AS p_size, CAST(p_retailprice AS DOUBLE) AS p_retailprice
FROM part
""")
def derive_passthrough_q(spark, sf_dir):
    """Empty expression list, first column not prt_path: typed rows, unpartitioned JSON."""
    root = scratch_path(spark, "wh_pass")
    write_delimited(table(spark, sf_dir, "part"), resolve(root, "model.d_part"))
    out = jobs.derive_job(spark, root, "model.d_part", "4ml.pass.d_part", PART_COLUMNS, [])
    schema = T.StructType([
        T.StructField("p_partkey", T.DoubleType()), T.StructField("p_name", T.StringType()),
        T.StructField("p_brand", T.StringType()), T.StructField("p_type", T.StringType()),
        T.StructField("p_size", T.DoubleType()), T.StructField("p_retailprice", T.DoubleType())])
    return read_feature_json(spark, out, schema)


@query("stream_merge", f"""
WITH ods AS (SELECT {ORDERS_TEXT_COLS.format(status='o_orderstatus')} FROM orders
             WHERE o_orderdate < TIMESTAMP '{ODS_BEFORE}'),
     stg AS (SELECT {ORDERS_TEXT_COLS.format(status="'F'")} FROM orders
             WHERE o_orderdate >= TIMESTAMP '{STG_FROM}')
SELECT * FROM ods o WHERE NOT EXISTS (SELECT 1 FROM stg s WHERE s.o_orderkey = o.o_orderkey)
UNION ALL SELECT * FROM stg
""")
def stream_merge_q(spark, sf_dir):
    """Two staging drops merged by two runs of the incremental merge stream."""
    from wareflow.streaming.ingest import ingest_merge
    root = scratch_path(spark, "wh_smerge")
    orders = table(spark, sf_dir, "orders")
    drops = resolve(root, "stg.d_orders")
    target = resolve(root, "ods.d_orders")
    ckpt = f"{root}/_checkpoint"
    early = orders.where(F.col("o_orderdate") < F.lit(ODS_BEFORE).cast("timestamp_ntz"))
    write_staging_csv(_orders_text(early), f"{drops}/drop=1")
    ingest_merge(spark, f"{drops}/*", f"{drops}/drop=1", target, [[":o_orderkey", 0]],
                 checkpoint=ckpt)
    later = orders.where(F.col("o_orderdate") >= F.lit(STG_FROM).cast("timestamp_ntz"))
    write_staging_csv(_orders_text(later).withColumn("o_orderstatus", F.lit("F")),
                      f"{drops}/drop=2")
    ingest_merge(spark, f"{drops}/*", f"{drops}/drop=1", target, [[":o_orderkey", 0]],
                 checkpoint=ckpt)
    return spark.read.parquet(target)
