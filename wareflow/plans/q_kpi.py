"""Driver queries for KPI sheets, deltas, groups and reports (S8, R1, J2-J4, F10-F12,
P10, P11, A1, A2, K9, C6).

The KPI sheet is built from the tables: per bottler (nation, underscores
removed) and channel (market segment), monthly counts of orders (``orders``)
and of urgent orders (``urgent``, only where non-zero, so the sheet has empty
cells). Groups are regions over their nations, except MIDDLE EAST, whose
nations stay unmapped.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wareflow.functions.columns import comparison_names
from wareflow.operators.kpi import (ID_COLUMNS, explode_long, period_deltas,
                                    read_kpi_sheet_long, unpivot_kpi)
from wareflow.operators.report import (match_constants, report, report_rows, report_table,
                                       report_tree)
from wareflow.plans.registry import query, table
from wareflow.session import scratch_path

UNMAPPED_REGION = "MIDDLE EAST"

# Fields by name, or by position in the long row (0 date, 1 group, 2 bottler,
# 3 channel, 4 kpi, 5 score, 6 pp, 7 ly, 8 tb).
SERIES_SPEC = {"selector": [(":Measure", "kpi"), (":Market", "channel")],
               "dimension": [(":date", "date")],
               "metrics": [(":score", "score"), (":score_tb", "score_tb")]}
GROUP_SPEC = {"selector": [(":Group", 1)],
              "dimension": [(":date", 0), ("orders", 4)],
              "metrics": [(":score", 5), (":score_tb", 8)]}
URGENT_SPEC = {"selector": [(":Measure", 4), (":Market", 3)],
               "dimension": [(":date", 0), ("urgent", 4)],
               "metrics": [(":score", 5), (":score_tb", 8)]}
CHANGE_SPEC = {"selector": [(":Measure", "kpi"), (":Market", "channel")],
               "dimension": [(":date", "date")],
               "metrics": [(":change", "score_pp"), (":region", "group")]}
TREE_SPEC = {"selector": [(":KPI", 4)],
             "dimension": [(":Group", 1), (":date", 0)],
             "metrics": [(":score", 5), (":score_tb", 8)]}


def kpi_cells(spark, sf_dir):
    """(bottler_cn, bottler_en, kpi_month, n) counts per bottler/channel/month."""
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    j = (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey))
    bottler = F.regexp_replace("n_name", "_", "")
    g = j.groupBy(F.lower(bottler).alias("bottler_cn"),
                  F.concat(bottler, F.lit("_"), F.col("c_mktsegment")).alias("bottler_en"),
                  F.date_format("o_orderdate", "MMMyy").alias("mon"),
                  F.trunc("o_orderdate", "month").alias("m"))
    counts = g.agg(F.count(F.lit(1)).alias("orders"),
                   F.count(F.when(F.col("o_orderpriority") == "1-URGENT", 1)).alias("urgent"))
    cells = counts.select("bottler_cn", "bottler_en", "m",
                          F.explode(F.array(
                              F.struct(F.lit("orders").alias("kpi"), F.col("orders").alias("n")),
                              F.struct(F.lit("urgent").alias("kpi"), F.col("urgent").alias("n")),
                          )).alias("x"), "mon")
    return cells.where(F.col("x.n") > 0).select(
        "bottler_cn", "bottler_en", "m", F.col("x.kpi").alias("kpi"),
        F.concat(F.col("x.kpi"), F.lit("_"), F.col("mon")).alias("kpi_month"),
        F.col("x.n").alias("n"))


def wide_sheet(spark, sf_dir):
    """Pivot to one column per ``<kpi>_<MMMyy>`` (names from the data, in order)."""
    cells = kpi_cells(spark, sf_dir)
    names = [r["kpi_month"] for r in
             cells.select("kpi", "m", "kpi_month").distinct().orderBy("kpi", "m").collect()]
    wide = (cells.groupBy(*ID_COLUMNS).pivot("kpi_month", names)
            .agg(F.first("n")))
    return wide, names


def write_sheet(spark, sf_dir, path):
    """The sheet as CSV text files (one per channel): header, two note rows, data.

    Columns after the ``_`` header cell are notes the reader must ignore.
    Each data line is built from the entity's cells (at most one per sheet
    column), so no wide frame is planned.
    """
    cells_path = scratch_path(spark, "kpi_cells")
    kpi_cells(spark, sf_dir).write.parquet(cells_path)
    cells = spark.read.parquet(cells_path)
    names = [r["kpi_month"] for r in
             cells.select("kpi", "m", "kpi_month").distinct().orderBy("kpi", "m").collect()]
    by_entity = cells.groupBy(*ID_COLUMNS).agg(
        F.map_from_entries(F.collect_list(F.struct("kpi_month", F.col("n").cast("string"))))
        .alias("_cells"))
    values = [F.coalesce(F.element_at("_cells", F.lit(n)), F.lit("")) for n in names]
    data = by_entity.select(
        F.concat_ws(",", *ID_COLUMNS, *values, F.lit(""), F.lit("ignored")).alias("value"),
        F.lit(2).alias("_order"), F.split("bottler_en", "_", 2)[1].alias("channel"))
    width = len(names) + 2
    header = ",".join(ID_COLUMNS + names + ["_", "note"])
    channels = (table(spark, sf_dir, "customer")
                .select(F.col("c_mktsegment").alias("channel")).distinct())
    notes = [channels.select(F.lit(",," + ",".join([text] * width)).alias("value"),
                             F.lit(k).alias("_order"), "channel")
             for k, text in ((0, "unit"), (1, "source"))]
    heads = channels.select(F.lit(header).alias("value"), F.lit(-1).alias("_order"), "channel")
    rows = heads.unionByName(notes[0]).unionByName(notes[1]).unionByName(data)
    (rows.repartition("channel").sortWithinPartitions("channel", "_order")
         .select("value", "channel").write.mode("overwrite").partitionBy("channel").text(path))
    return path


def long_from_wide(wide):
    return unpivot_kpi(wide).select(
        *ID_COLUMNS, "kpi", F.date_format("month", "yyyy-MM").alias("month"), "value")


LONG_SQL = """
j AS (SELECT lower(replace(n_name, '_', '')) AS bottler_cn,
             replace(n_name, '_', '') || '_' || c_mktsegment AS bottler_en,
             replace(n_name, '_', '') AS bottler, c_mktsegment AS channel,
             date_trunc('month', o_orderdate) AS m, o_orderpriority
      FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
l AS (SELECT bottler_cn, bottler_en, bottler, channel, 'orders' AS kpi, m,
             CAST(count(*) AS DOUBLE) AS value FROM j GROUP BY ALL
      UNION ALL
      SELECT bottler_cn, bottler_en, bottler, channel, 'urgent' AS kpi, m,
             CAST(count(*) AS DOUBLE) AS value FROM j WHERE o_orderpriority = '1-URGENT'
      GROUP BY ALL)
"""

LONG_OUT_SQL = f"""
WITH {LONG_SQL}
SELECT bottler_cn, bottler_en, kpi, strftime(m, '%Y-%m') AS month, value FROM l
"""


@query("kpi_unpivot", LONG_OUT_SQL)
def kpi_unpivot(spark, sf_dir):
    """Wide KPI columns back to long rows; empty cells skipped."""
    wide, _ = wide_sheet(spark, sf_dir)
    return long_from_wide(wide)


@query("kpi_sheet", LONG_OUT_SQL)
def kpi_sheet(spark, sf_dir):
    """Sheet files (header, notes, sentinel) read, cut at ``_``, unpivoted."""
    path = write_sheet(spark, sf_dir, scratch_path(spark, "kpi_sheet"))
    return read_kpi_sheet_long(spark, path).select(
        *ID_COLUMNS, "kpi", F.date_format("month", "yyyy-MM").alias("month"), "value")


@query("kpi_names", f"""
WITH {LONG_SQL}
SELECT DISTINCT kpi || '_' || strftime(m, '%b%y') AS kpi_month,
       kpi || '_' || strftime(m - INTERVAL 1 MONTH, '%b%y') AS pp,
       kpi || '_Dec' || strftime(m - INTERVAL 12 MONTH, '%y') AS ly,
       kpi || '_' || strftime(m - INTERVAL 12 MONTH, '%b%y') AS tb
FROM l
""")
def kpi_names(spark, sf_dir):
    """Column names of the three comparison periods of every KPI column."""
    names = kpi_cells(spark, sf_dir).select("kpi_month").distinct()
    c = comparison_names(F.col("kpi_month"))
    return names.select("kpi_month", c["pp"].alias("pp"), c["ly"].alias("ly"),
                        c["tb"].alias("tb"))


def long_values(spark, sf_dir):
    """The long (ids, kpi, month, value) rows straight from the counts.

    The same rows the sheet unpivots to (checked by kpi_unpivot / kpi_sheet);
    the report queries start here instead of pivoting and unpivoting again.
    """
    return kpi_cells(spark, sf_dir).select(
        *ID_COLUMNS, "kpi", F.col("m").alias("month"), F.col("n").cast("double").alias("value"))


def _deltas(spark, sf_dir):
    return period_deltas(long_values(spark, sf_dir), ID_COLUMNS)


DELTAS_SQL = f"""
{LONG_SQL},
d AS (SELECT a.bottler_cn, a.bottler_en, a.bottler, a.channel, a.kpi, a.m, a.value,
             a.value - coalesce(p.value, 0) AS score_pp,
             a.value - coalesce(y.value, 0) AS score_ly,
             a.value - coalesce(t.value, 0) AS score_tb
      FROM l a
      LEFT JOIN l p ON p.bottler_en = a.bottler_en AND p.kpi = a.kpi
                   AND p.m = a.m - INTERVAL 1 MONTH
      LEFT JOIN l y ON y.bottler_en = a.bottler_en AND y.kpi = a.kpi
                   AND y.m = make_date(year(a.m) - 1, 12, 1)
      LEFT JOIN l t ON t.bottler_en = a.bottler_en AND t.kpi = a.kpi
                   AND t.m = a.m - INTERVAL 12 MONTH)
"""


@query("kpi_deltas", f"""
WITH {DELTAS_SQL}
SELECT bottler_en, kpi, strftime(m, '%Y-%m') AS month, value, score_pp, score_ly, score_tb FROM d
""")
def kpi_deltas(spark, sf_dir):
    """Score minus previous month, last December and same month last year."""
    return _deltas(spark, sf_dir).select(
        "bottler_en", "kpi", F.date_format("month", "yyyy-MM").alias("month"), "value",
        "score_pp", "score_ly", "score_tb")


def region_groups(spark, sf_dir):
    """(member, group): each region over its nations' bottler codes."""
    r, n = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
            .where(F.col("r_name") != UNMAPPED_REGION)
            .select(F.regexp_replace("n_name", "_", "").alias("member"),
                    F.col("r_name").alias("group")))


def long_rows(spark, sf_dir):
    return explode_long(_deltas(spark, sf_dir), region_groups(spark, sf_dir))


LONG_ROWS_SQL = f"""
{DELTAS_SQL},
g AS (SELECT replace(n_name, '_', '') AS member, r_name AS grp
      FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> '{UNMAPPED_REGION}'),
lr AS (SELECT strftime(d.m, '%Y-%m') AS date, g.grp AS "group", d.bottler, d.channel, d.kpi,
              d.value AS score, d.score_pp, d.score_ly, d.score_tb
       FROM d LEFT JOIN g ON g.member = d.bottler)
"""


@query("group_lookup", f"""
WITH {LONG_ROWS_SQL}
SELECT * FROM lr
""")
def group_lookup(spark, sf_dir):
    """Long KPI rows with their bottler group (NULL when unmapped)."""
    return long_rows(spark, sf_dir)


@query("report_constants", f"""
WITH {LONG_ROWS_SQL}
SELECT date, bottler, score FROM lr WHERE channel = 'BUILDING' AND kpi = 'orders'
""")
def report_constants(spark, sf_dir):
    """Rows matching a spec's constant dimensions."""
    spec = {"dimension": [(":date", 0), ("BUILDING", 3), ("orders", 4)]}
    return match_constants(long_rows(spark, sf_dir), spec).select("date", "bottler", "score")


def _report_text(rep):
    item = F.transform("items", lambda x: F.concat(
        F.array_join(F.transform(x["dims"], lambda d: F.concat(d["name"], F.lit("="),
                                                               F.coalesce(d["value"], F.lit("null")))), "|"),
        F.lit("|score="), x["metrics"]["score"].cast("string"),
        F.lit("|score_tb="), x["metrics"]["score_tb"].cast("string")))
    return rep.select("segment", "selector", F.size("items").cast("bigint").alias("n_items"),
                      F.array_join(item, ";").alias("items_text"))


def _items_sql(select_rows: str) -> str:
    return f"""
SELECT segment, selector, count(*) AS n_items,
       string_agg(dims || '|score=' || CAST(score AS VARCHAR) || '|score_tb='
                  || CAST(score_tb AS VARCHAR), ';' ORDER BY dims, score, score_tb) AS items_text
FROM ({select_rows}) GROUP BY segment, selector
"""


SERIES_ROWS_SQL = """
SELECT 'date' AS segment,
       '[["Measure","' || kpi || '"],["Market","' || channel || '"]]' AS selector, 'date=' || date AS dims, score, score_tb FROM lr
"""


@query("report_group", f"""
WITH {LONG_ROWS_SQL}
{_items_sql(SERIES_ROWS_SQL)}
""")
def report_group(spark, sf_dir):
    """One document per measure and market, items by date."""
    return _report_text(report(long_rows(spark, sf_dir), [SERIES_SPEC]))


@query("report_multi", f"""
WITH {LONG_ROWS_SQL}
{_items_sql(SERIES_ROWS_SQL + '''
UNION ALL
SELECT 'date' AS segment, '[["Group",' || coalesce('"' || "group" || '"', 'null') || ']]' AS selector,
       'date=' || date AS dims, score, score_tb FROM lr WHERE kpi = 'orders'
UNION ALL
SELECT 'date' AS segment,
       '[["Measure","' || kpi || '"],["Market","' || channel || '"]]' AS selector, 'date=' || date AS dims, score, score_tb FROM lr WHERE kpi = 'urgent'
''')}
""")
def report_multi(spark, sf_dir):
    """Several specs accumulate into the same (segment, selector) lists."""
    specs = [SERIES_SPEC, GROUP_SPEC, URGENT_SPEC]
    return _report_text(report(long_rows(spark, sf_dir), specs))


def _tree_sql(rows_cte: str, group: str = '"group"') -> str:
    return f"""
{rows_cte},
leaf AS (SELECT kpi, coalesce({group}, 'null') AS g, date,
                '{{"items":[' || string_agg('{{"score":' || CAST(score AS VARCHAR) || ',"score_tb":'
                || CAST(score_tb AS VARCHAR) || '}}', ',' ORDER BY score, score_tb) || ']}}' AS node
         FROM lr GROUP BY ALL),
lvl1 AS (SELECT kpi, g, '{{' || string_agg('"[date, ' || date || ']":' || node, ','
                ORDER BY '[date, ' || date || ']') || '}}' AS node FROM leaf GROUP BY kpi, g),
lvl0 AS (SELECT kpi, '{{' || string_agg('"[Group, ' || g || ']":' || node, ','
                ORDER BY '[Group, ' || g || ']') || '}}' AS data
         FROM lvl1 GROUP BY kpi)
"""


@query("report_tree", f"""
WITH {_tree_sql(LONG_ROWS_SQL)}
SELECT 'Group_date' AS segment, '[["KPI","' || kpi || '"]]' AS selector, data FROM lvl0
""")
def report_tree_q(spark, sf_dir):
    """Two-level JSON tree per KPI: group, then date, then sorted items."""
    return report_tree(report_rows(long_rows(spark, sf_dir), [TREE_SPEC]), 2)


@query("report_tree_null", f"""
WITH {_tree_sql(LONG_ROWS_SQL, """CASE WHEN "group" = 'AFRICA' THEN 'null' ELSE "group" END""")}
SELECT 'Group_date' AS segment, '[["KPI","' || kpi || '"]]' AS selector, data FROM lvl0
""")
def report_tree_null(spark, sf_dir):
    """Bottlers without a group beside a group called ``null``: both print alike and share a key."""
    rows = long_rows(spark, sf_dir).withColumn(
        "group", F.when(F.col("group") == "AFRICA", "null").otherwise(F.col("group")))
    return report_tree(report_rows(rows, [TREE_SPEC]), 2)


@query("report_mixed", f"""
WITH {LONG_ROWS_SQL},
item AS (SELECT kpi, channel, date, '{{"score":' || CAST(score AS VARCHAR) || ',"score_tb":' || CAST(score_tb AS VARCHAR) || '}}' AS item FROM lr
         UNION ALL
         SELECT kpi, channel, date, '{{"change":' || CAST(score_pp AS VARCHAR) || ',"region":' || coalesce('"' || "group" || '"', 'null') || '}}' AS item FROM lr),
leaf AS (SELECT kpi, channel, date, '{{"items":[' || string_agg(item, ',' ORDER BY item) || ']}}' AS node FROM item GROUP BY ALL)
SELECT 'score' AS category, 'date' AS name, '[["Measure","' || kpi || '"],["Market","' || channel || '"]]' AS selector,
       '{{' || string_agg('"[date, ' || date || ']":' || node, ',' ORDER BY date) || '}}' AS data
FROM leaf GROUP BY kpi, channel
""")
def report_mixed(spark, sf_dir):
    """Two specs with different metrics in the same documents: items of both shapes, NULL metrics as null."""
    return report_table(long_rows(spark, sf_dir), [SERIES_SPEC, CHANGE_SPEC])


KPI_JOB_SQL = f"""
WITH {LONG_ROWS_SQL},
leaf AS (SELECT channel, kpi, date,
                '{{"items":[' || string_agg('{{"score":' || CAST(score AS VARCHAR) || ',"score_tb":'
                || CAST(score_tb AS VARCHAR) || '}}', ',' ORDER BY score, score_tb) || ']}}' AS node
         FROM lr GROUP BY ALL),
tree AS (SELECT channel, kpi, '{{' || string_agg('"[date, ' || date || ']":' || node, ','
                ORDER BY '[date, ' || date || ']') || '}}' AS data FROM leaf GROUP BY ALL)
SELECT 'score' AS category, 'date' AS name,
       '[["Measure","' || kpi || '"],["Market","' || channel || '"]]' AS selector, data FROM tree
UNION ALL
SELECT DISTINCT 'score' AS category, 'archive' AS name,
       '[["Measure","' || kpi || '"],["Market","' || channel || '"]]' AS selector, '{{}}' AS data FROM lr
"""


@query("kpi_job", KPI_JOB_SQL)
def kpi_job(spark, sf_dir):
    """Sheet file -> long rows -> report trees -> keyed replace into the report table.

    The stored table (an earlier run) holds a stale row under every key the
    job reports (replaced) and an ``archive`` row per selector (not reported
    again, so kept).
    """
    from wareflow.plans.jobs import kpi_job as run_kpi_job
    sheet = write_sheet(spark, sf_dir, scratch_path(spark, "kpi_job_sheet"))
    target = scratch_path(spark, "kpi_report")
    selector = F.to_json(F.array(F.array(F.lit("Measure"), F.col("kpi")),
                                 F.array(F.lit("Market"), F.get(F.split("bottler_en", "_", 2), 1))))
    keys = kpi_cells(spark, sf_dir).select(selector.alias("selector")).distinct()
    stored = keys.select(F.lit("score").alias("category"),
                         F.explode(F.array(F.lit("date"), F.lit("archive"))).alias("name"),
                         "selector", F.lit("{}").alias("data"))
    stored.write.parquet(target)
    run_kpi_job(spark, sheet, region_groups(spark, sf_dir), [SERIES_SPEC], target)
    return spark.read.parquet(target)
