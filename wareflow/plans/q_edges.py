"""Driver queries for dependency edges and option maps.

Edges come from the tables: region -> nation -> customer -> order -> part
(a part depends on every order that contains it).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wareflow.operators.edges import SCHEDULED_DEFAULTS, invert, links, roots, tagged, with_defaults
from wareflow.plans.registry import query, table


def table_edges(spark, sf_dir):
    r, n, c, o, li = (table(spark, sf_dir, t)
                      for t in ("region", "nation", "customer", "orders", "lineitem"))
    e1 = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("r_name").alias("parent"), F.col("n_name").alias("child"))
    e2 = c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("n_name").alias("parent"),
        F.concat(F.lit("cust"), F.col("c_custkey").cast("string")).alias("child"))
    e3 = o.select(F.concat(F.lit("cust"), F.col("o_custkey").cast("string")).alias("parent"),
                  F.concat(F.lit("order"), F.col("o_orderkey").cast("string")).alias("child"))
    e4 = li.select(F.concat(F.lit("order"), F.col("l_orderkey").cast("string")).alias("parent"),
                   F.concat(F.lit("part"), F.col("l_partkey").cast("string")).alias("child"))
    return e1.unionByName(e2).unionByName(e3).unionByName(e4)


EDGES_SQL = """
e AS (SELECT DISTINCT parent, child FROM (
  SELECT r_name AS parent, n_name AS child FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT n_name, 'cust' || CAST(c_custkey AS VARCHAR)
            FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT 'cust' || CAST(o_custkey AS VARCHAR), 'order' || CAST(o_orderkey AS VARCHAR)
            FROM orders
  UNION ALL SELECT 'order' || CAST(l_orderkey AS VARCHAR), 'part' || CAST(l_partkey AS VARCHAR)
            FROM lineitem))
"""


@query("graph_invert", f"""
WITH {EDGES_SQL}
SELECT child AS node, parent, count(*) OVER (PARTITION BY child) AS n_parents FROM e
""")
def graph_invert(spark, sf_dir):
    """Each node with each node it depends on, and how many."""
    return invert(table_edges(spark, sf_dir))


@query("graph_roots", f"""
WITH {EDGES_SQL}
SELECT DISTINCT parent AS node FROM e WHERE parent NOT IN (SELECT child FROM e)
""")
def graph_roots(spark, sf_dir):
    """Nodes that nothing else points to (scheduled, not dependent, jobs)."""
    return roots(table_edges(spark, sf_dir))


def graph_lines(spark, sf_dir):
    """Scheduler graph text: ``node,<type>-e<id>`` and ``link,<type>-u<user>,<type>-e<id>``."""
    ev = table(spark, sf_dir, "events")
    node = F.concat(F.col("event_type"), F.lit("-e"), F.col("event_id").cast("string"))
    user = F.concat(F.col("event_type"), F.lit("-u"), F.col("user_id").cast("string"))
    return ev.select(F.explode(F.array(
        F.concat(F.lit("node,"), node),
        F.concat(F.lit("link,"), user, F.lit(","), node))).alias("value"))


@query("tagged_lines", """
SELECT 'node' AS kind, 'click-e' || CAST(event_id AS VARCHAR) AS a, CAST(NULL AS VARCHAR) AS b
FROM events WHERE event_type = 'click'
UNION ALL
SELECT 'link', 'click-u' || CAST(user_id AS VARCHAR), 'click-e' || CAST(event_id AS VARCHAR)
FROM events WHERE event_type = 'click'
""")
def tagged_lines(spark, sf_dir):
    """Node names and links of one job prefix picked from graph text lines."""
    lines = graph_lines(spark, sf_dir)
    nodes = tagged(lines, "node", "click").select(
        F.lit("node").alias("kind"), F.col("name").alias("a"), F.lit(None).cast("string").alias("b"))
    edges = links(lines, "click").select(F.lit("link").alias("kind"),
                                         F.col("parent").alias("a"), F.col("child").alias("b"))
    return nodes.unionByName(edges)


@query("map_defaults", """
SELECT event_id, 'job-' || CAST(event_id AS VARCHAR) AS name,
       CASE WHEN event_type IN ('click', 'view') THEN 'run ' || event_type
            ELSE 'echo dummy' END AS command,
       CASE WHEN event_type = 'purchase' THEN 'R//PT2H' ELSE 'R10//P' END AS schedule,
       3 AS n_keys
FROM events
""")
def map_defaults(spark, sf_dir):
    """Job options over the scheduled-job defaults (given keys win)."""
    ev = table(spark, sf_dir, "events")
    name = F.create_map(F.lit("name"), F.concat(F.lit("job-"), F.col("event_id").cast("string")))
    cmd = F.when(F.col("event_type").isin("click", "view"),
                 F.create_map(F.lit("command"), F.concat(F.lit("run "), F.col("event_type"))))
    sched = F.when(F.col("event_type") == "purchase",
                   F.create_map(F.lit("schedule"), F.lit("R//PT2H")))
    empty = F.create_map().cast("map<string,string>")
    given = F.map_concat(name, F.coalesce(cmd, empty), F.coalesce(sched, empty))
    opts = with_defaults(given, SCHEDULED_DEFAULTS)
    return ev.select("event_id", opts["name"].alias("name"), opts["command"].alias("command"),
                     opts["schedule"].alias("schedule"), F.size(opts).alias("n_keys"))
