"""Dependency edges: inversion, roots, tagged lines, option maps.

Edges are a (parent, child) DataFrame: "child depends on parent". The
inverted adjacency (child -> its parents) stays an edge list with a per-node
count; a node's parents are never gathered into one row, so a node with a
huge in-degree costs no more than its share of edges.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wareflow.operators.keys import per_key

# Fixed values (must equal the reference's): the option defaults of a
# scheduled job.
SCHEDULED_DEFAULTS = {"command": "echo dummy", "schedule": "R10//P"}


def adjacency_edges(adjacency: DataFrame, key: str = "job", deps: str = "deps") -> DataFrame:
    """(key, array of dependents) rows -> distinct (parent, child) edges."""
    return (adjacency.select(F.col(key).alias("parent"), F.explode(deps).alias("child"))
            .distinct())


def invert(edges: DataFrame) -> DataFrame:
    """(node, parent, n_parents): each child with each of its parents.

    The count is a partial aggregation per node joined back on the node (one
    row per node on that side, re-shuffled for the join), so a hot node's
    edges are split by AQE's skew handling rather than sent to one task.
    """
    e = edges.select(F.col("child").alias("node"), "parent").distinct()
    counts = per_key(e, ["node"], F.count(F.lit(1)).alias("n_parents"))
    return e.join(counts, "node")


def dependents(edges: DataFrame) -> DataFrame:
    """Distinct nodes that depend on something (children)."""
    return edges.select(F.col("child").alias("node")).distinct()


def roots(edges: DataFrame) -> DataFrame:
    """Nodes that have dependents but depend on nothing: parents minus children."""
    parents = edges.select(F.col("parent").alias("node")).distinct()
    return parents.join(dependents(edges), "node", "left_anti")


def tagged(lines: DataFrame, tag: str, prefix: str, field: int = 1,
           column: str = "value") -> DataFrame:
    """Field ``field`` of comma lines starting ``<tag>,<prefix>-``."""
    start = f"{tag},{prefix}-"
    sel = lines.where(F.col(column).startswith(start))
    return sel.select(F.get(F.split(F.col(column), ",", -1), field).alias("name"))


def links(lines: DataFrame, prefix: str, column: str = "value") -> DataFrame:
    """(parent, child) from ``link,<prefix>-<a>,<b>`` lines."""
    sel = lines.where(F.col(column).startswith(f"link,{prefix}-"))
    parts = F.split(F.col(column), ",", -1)
    return sel.select(F.get(parts, 1).alias("parent"), F.get(parts, 2).alias("child"))


def with_defaults(given: Column, defaults: Mapping[str, str]) -> Column:
    """Option map: ``defaults`` overlaid by ``given`` (given keys win).

    Default entries whose key is given are filtered out first, so the overlay
    never meets a duplicate key.
    """
    items = []
    for k, v in defaults.items():
        items += [F.lit(k), F.lit(v)]
    base = F.create_map(*items)
    kept = F.map_filter(base, lambda k, _v: ~F.array_contains(F.map_keys(given), k))
    return F.map_concat(kept, given)
