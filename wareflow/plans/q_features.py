"""Driver queries for feature configs.

One feature-config document per customer, built by Spark from the customer
row (its id, its segment and its balance shape the document), so the number
of documents grows with the table. Segments BUILDING and MACHINERY spell the
id field ``classified_id``, the rest ``classId``; HOUSEHOLD customers get a
second data source. The oracle builds the same item rows directly in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wareflow.operators.features import (columns_for, exprs_for, feature_catalog,
                                         feature_roles, parse_job_id, role_rows)
from wareflow.plans.registry import query, table

DATA_ROOT = "var/data"

# (source, [(list_name, [(item, type or None, expr SQL or None)])]); expr SQL
# is valid in both Spark SQL and DuckDB and is evaluated per customer row.
BIG_EXPR = "':o_totalprice > ' || CAST(CAST(FLOOR(c_acctbal * 40) AS BIGINT) AS STRING)"
SOURCES = [
    ("d_orders", [
        ("column_items", [("o_orderkey", "number", None), ("o_orderstatus", "string", None),
                          ("o_orderdate", "date", None), ("o_totalprice", "number", None),
                          ("o_orderpriority", None, None)]),
        ("driven_items", [("o_totalprice", "number", None), ("big", "boolean", BIG_EXPR),
                          ("o_orderpriority", None, None)]),
        ("target_items", [("o_orderstatus", "string", None),
                          ("late", "boolean", "':o_orderstatus == ''F'' || :big'")]),
    ]),
    ("d_lineitem", [
        ("column_items", [("l_orderkey", "number", None), ("l_quantity", "number", None),
                          ("l_returnflag", "string", None)]),
        ("driven_items", [("l_quantity", "number", None),
                          ("bulk", "boolean", "':l_quantity > 30'")]),
        ("target_items", [("l_returnflag", "string", None)]),
    ]),
]
SECOND_SOURCE_SEGMENT = "HOUSEHOLD"
CLASS_ID_SQL = "'cls' || CAST(c_custkey AS STRING)"
ID_FIELD_SQL = ("CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') "
                "THEN 'classified_id' ELSE 'classId' END")


def _lists_map(lists):
    entries = []
    for list_name, items in lists:
        structs = [F.struct(F.lit(i).alias("data_item"),
                            F.lit(t).cast("string").alias("data_type"),
                            (F.expr(e) if e else F.lit(None)).cast("string").alias("expr"))
                   for i, t, e in items]
        entries += [F.lit(list_name), F.array(*structs)]
    return F.create_map(*entries)


def config_docs(spark, sf_dir):
    """(c_custkey, config) with one JSON feature config per customer."""
    cust = table(spark, sf_dir, "customer")
    first = F.create_map(F.lit(SOURCES[0][0]), _lists_map(SOURCES[0][1]))
    both = F.map_concat(first, F.create_map(F.lit(SOURCES[1][0]), _lists_map(SOURCES[1][1])))
    sources = F.when(F.col("c_mktsegment") == SECOND_SOURCE_SEGMENT, both).otherwise(first)
    doc = F.concat(F.lit('{"'), F.expr(ID_FIELD_SQL), F.lit('":"'), F.expr(CLASS_ID_SQL),
                   F.lit('","data_sources":'), F.to_json(sources), F.lit("}"))
    return cust.select("c_custkey", doc.alias("config"))


def catalog_sql() -> str:
    """Item rows of every config, written out directly (no JSON parsing)."""
    parts = []
    for s_idx, (source, lists) in enumerate(SOURCES):
        where = "" if s_idx == 0 else f" WHERE c_mktsegment = '{SECOND_SOURCE_SEGMENT}'"
        for list_pos, (list_name, items) in enumerate(lists):
            for pos, (item, typ, expr) in enumerate(items):
                t = f"'{typ}'" if typ else "CAST(NULL AS VARCHAR)"
                e = expr if expr else "CAST(NULL AS VARCHAR)"
                parts.append(
                    f"SELECT {CLASS_ID_SQL} AS class_id, '{source}' AS source, "
                    f"'{list_name}' AS list_name, {list_pos} AS list_pos, {pos} AS pos, "
                    f"'{item}' AS data_item, {t} AS data_type, {e} AS expr "
                    f"FROM customer{where}")
    return "\n UNION ALL ".join(parts)


def _catalog(spark, sf_dir):
    return feature_catalog(config_docs(spark, sf_dir))


@query("feature_catalog", f"""
SELECT class_id, source, list_name, CAST(list_pos AS INTEGER) AS list_pos,
       CAST(pos AS INTEGER) AS pos, data_item, data_type, expr
FROM ({catalog_sql()})
""")
def feature_catalog_q(spark, sf_dir):
    """Config JSON documents -> one row per item (either id field accepted)."""
    return _catalog(spark, sf_dir)


@query("config_columns", f"""
WITH cat AS ({catalog_sql()}),
model AS (SELECT DISTINCT class_id, source, data_item FROM cat
          WHERE list_name IN ('driven_items', 'target_items'))
SELECT DISTINCT class_id, source, 0 AS pos, '''prt_path' AS column_marker FROM cat
UNION ALL
SELECT c.class_id, c.source, CAST(c.pos + 1 AS INTEGER) AS pos,
       (CASE WHEN c.data_type IN ('string', 'date') THEN '''' ELSE '' END)
       || (CASE WHEN m.data_item IS NOT NULL THEN '' ELSE '_' END) || c.data_item AS column_marker
FROM cat c LEFT JOIN model m
  ON m.class_id = c.class_id AND m.source = c.source AND m.data_item = c.data_item
WHERE c.list_name = 'column_items'
""")
def config_columns(spark, sf_dir):
    """Column markers per config: string/date marked, unused items hidden."""
    return columns_for(_catalog(spark, sf_dir))


@query("config_exprs", f"""
SELECT class_id, source, CAST(list_pos AS INTEGER) AS list_pos, CAST(pos AS INTEGER) AS pos,
       ':' || data_item AS target, expr AS body
FROM ({catalog_sql()}) WHERE expr IS NOT NULL AND trim(expr) <> ''
""")
def config_exprs(spark, sf_dir):
    """Expressions per config, in list order."""
    return exprs_for(_catalog(spark, sf_dir))


ROLES_SQL = f"""
WITH cat AS (SELECT class_id, source, list_name, list_pos, pos, data_item,
                    COALESCE(NULLIF(trim(data_type), ''), 'string') AS data_type, expr
             FROM ({catalog_sql()})),
declared AS (SELECT class_id, source, data_item, data_type FROM cat
             WHERE list_name = 'column_items'
                OR (list_name IN ('driven_items', 'target_items') AND expr IS NOT NULL)),
model AS (SELECT class_id, source, data_item, data_type FROM cat
          WHERE list_name IN ('driven_items', 'target_items')),
both_ AS (SELECT * FROM declared INTERSECT SELECT * FROM model),
targets AS (SELECT DISTINCT class_id, source, data_item FROM cat WHERE list_name = 'target_items'),
ordered AS (
  SELECT b.class_id, b.source, b.data_item, b.data_type,
         CASE WHEN t.data_item IS NOT NULL THEN 'TargetCol' ELSE 'InputCol' END AS role,
         (SELECT min((CASE WHEN c.list_name = 'column_items' THEN 0 ELSE 1 END) * 1000000
                     + c.list_pos * 1000 + c.pos)
          FROM cat c WHERE c.class_id = b.class_id AND c.source = b.source
            AND c.data_item = b.data_item AND c.data_type = b.data_type
            AND (c.list_name = 'column_items' OR c.expr IS NOT NULL)) AS ord
  FROM both_ b LEFT JOIN targets t
    ON t.class_id = b.class_id AND t.source = b.source AND t.data_item = b.data_item)
"""


@query("feature_roles", ROLES_SQL + """
SELECT class_id, source, role, data_item, data_type FROM ordered
""")
def feature_roles_q(spark, sf_dir):
    """Declared items that the model uses, labelled TargetCol / InputCol."""
    return feature_roles(_catalog(spark, sf_dir)).drop("item_order")


def _jobs(spark, sf_dir):
    """(class_id, source, job_id): prediction window = the customer's order dates."""
    cat = _catalog(spark, sf_dir).select("class_id", "source").distinct()
    orders = table(spark, sf_dir, "orders")
    span = orders.groupBy("o_custkey").agg(
        F.date_format(F.min("o_orderdate"), "yyyyMMdd").alias("d0"),
        F.date_format(F.max("o_orderdate"), "yyyyMMdd").alias("d1"))
    cls = span.select(F.concat(F.lit("cls"), F.col("o_custkey").cast("string")).alias("class_id"),
                      "d0", "d1")
    jobs = cat.join(cls, "class_id", "left").select(
        "class_id", "source",
        F.concat(F.lit("wh-"), F.col("class_id"), F.lit("_"),
                 F.coalesce("d0", F.lit("none")), F.lit("_"),
                 F.coalesce("d1", F.lit("none")), F.lit("_roleJob")).alias("job_id"))
    return jobs


JOBS_SQL = f"""
jobs AS (
  SELECT k.class_id, k.source,
         coalesce(strftime(s.d0, '%Y%m%d'), 'none') AS d0,
         coalesce(strftime(s.d1, '%Y%m%d'), 'none') AS d1
  FROM (SELECT DISTINCT class_id, source FROM ({catalog_sql()})) k
  LEFT JOIN (SELECT 'cls' || CAST(o_custkey AS VARCHAR) AS class_id,
                    min(o_orderdate) AS d0, max(o_orderdate) AS d1
             FROM orders GROUP BY o_custkey) s ON s.class_id = k.class_id)
"""


@query("job_id_parse", f"""
WITH {JOBS_SQL}
SELECT 'wh-' || class_id || '_' || d0 || '_' || d1 || '_roleJob' AS job_id,
       class_id AS parsed_class_id, d0 AS pred_start, d1 AS pred_end
FROM jobs
""")
def job_id_parse(spark, sf_dir):
    """Class id and prediction window recovered from job ids."""
    jobs = _jobs(spark, sf_dir)
    p = parse_job_id(F.col("job_id"))
    return jobs.select("job_id", p["class_id"].alias("parsed_class_id"),
                       p["start"].alias("pred_start"), p["end"].alias("pred_end"))


@query("role_rows", ROLES_SQL + f""",
{JOBS_SQL},
counts AS (SELECT class_id, source, count(*) AS n FROM ordered GROUP BY class_id, source)
SELECT class_id, source,
       CAST(row_number() OVER (PARTITION BY class_id, source ORDER BY ord) AS INTEGER) AS line_no,
       role || ',' || data_item || ',' || data_type AS line
FROM ordered
UNION ALL
SELECT j.class_id, j.source, CAST(coalesce(c.n, 0) + k AS INTEGER) AS line_no,
       CASE k WHEN 1 THEN 'PredStartDate,' || j.d0 || ',Date'
              WHEN 2 THEN 'PredEndDate,' || j.d1 || ',Date'
              WHEN 3 THEN 'InputDataPath,{DATA_ROOT}/in/' || j.class_id || '/' || j.source
                          || '/data.csv,string'
              ELSE 'OutDataPath,{DATA_ROOT}/out/' || j.class_id || '/data.csv,string' END AS line
FROM jobs j LEFT JOIN counts c ON c.class_id = j.class_id AND c.source = j.source
CROSS JOIN (VALUES (1), (2), (3), (4)) AS t(k)
""")
def role_rows_q(spark, sf_dir):
    """Role-file lines per config (the role job writes them, one file per config)."""
    cat = _catalog(spark, sf_dir)
    return role_rows(feature_roles(cat), _jobs(spark, sf_dir), DATA_ROOT)
