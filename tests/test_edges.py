from pyspark.sql import functions as F

from wareflow.operators.edges import (SCHEDULED_DEFAULTS, adjacency_edges, invert, links, roots,
                                      tagged, with_defaults)

from conftest import rows

# Two roots, a diamond and a side branch.
DEPS = {"parse": ["clean", "audit"], "fetch": ["clean"], "clean": ["index", "stats"],
        "index": ["serve"], "stats": ["serve"]}


def _edges(spark):
    adj = spark.createDataFrame(list(DEPS.items()), "job string, deps array<string>")
    return adjacency_edges(adj)


def test_roots_and_inversion(spark):
    e = _edges(spark)
    assert rows(roots(e)) == [("fetch",), ("parse",)]
    inv = invert(e)
    for node in ("clean", "serve"):
        parents = inv.where(F.col("node") == node)
        assert parents.count() == 2 and rows(parents.select("n_parents").distinct()) == [(2,)]


def test_tagged_lines(spark):
    lines = spark.createDataFrame([("node,team-a",), ("node,other-b",), ("link,team-a,team-c",)],
                                  "value string")
    assert rows(tagged(lines, "node", "team")) == [("team-a",)]
    assert rows(links(lines, "team")) == [("team-a", "team-c")]


def test_defaults_overlay(spark):
    df = spark.createDataFrame([({"name": "j", "schedule": "R//PT2H"},)], "m map<string,string>")
    out = df.select(with_defaults(F.col("m"), SCHEDULED_DEFAULTS).alias("o")).collect()[0].o
    assert out == {"command": "echo dummy", "name": "j", "schedule": "R//PT2H"}
