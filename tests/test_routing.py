"""Routing by each row's own path, values with separators, exact sinks and fresh listings."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from wareflow.operators.features import feature_catalog, feature_roles, role_rows
from wareflow.operators.partition import parse_prt_path, with_levels, with_prt_path
from wareflow.plans import jobs
from wareflow.functions.spec import resolve
from wareflow.sinks.files import export_parts, write_delimited, write_staging_csv


def test_level_values_may_hold_slashes(spark):
    df = spark.createDataFrame([("a/b", "N/A"), ("x=y", "N/A"), (None, "q")], "a string, b string")
    spec = [("la", F.col("a")), ("lb", F.col("b"))]
    want = [("", "q"), ("a/b", "N/A"), ("x=y", "N/A")]
    assert rows(parse_prt_path(with_prt_path(df, spec), ["la", "lb"]), "la", "lb") == want
    assert rows(with_levels(df, spec), "la", "lb") == want
    none = spark.createDataFrame([("lb=2",), (None,)], "prt_path string")
    assert [tuple(r) for r in parse_prt_path(none, ["la", "lb"]).select("la", "lb").collect()] == [(None, "2"), (None, None)]


def _derive(spark, root, data, columns):
    write_delimited(spark.createDataFrame(data, "prt_path string, v string"), resolve(root, "model.t"))
    return jobs.derive_job(spark, root, "model.t", "4ml.t", columns)


def test_rows_route_by_their_own_levels(spark, scratch):
    root = scratch("route")
    out = _derive(spark, root, [("p=1/q=a", "x"), ("p=2/q=N/A", "y"), ("r=5", "z")], ["'prt_path", "'v"])
    assert rows(spark.read.json(out + "/p=1"), "v") == [("x",)]
    assert rows(spark.read.json(out + "/levels.r/r=5"), "v") == [("z",)]      # a list of levels has a folder of its own
    assert rows(spark.read.json(out + "/p=2"), "q", "v") == [("N/A", "y")]


def test_hidden_path_still_routes_and_empty_source_replaces_nothing(spark, scratch):
    root = scratch("hide")
    out = _derive(spark, root, [("p=1", "x"), ("p=2", "y")], ["'_prt_path", "'v"])
    _derive(spark, root, [("p=2", "Y")], ["'_prt_path", "'v"])
    assert rows(spark.read.json(out), "p", "v") == [("1", "x"), ("2", "Y")]
    assert "prt_path" not in spark.read.json(out).columns
    _derive(spark, root, [], ["'_prt_path", "'v"])
    assert rows(spark.read.json(out), "p", "v") == [("1", "x"), ("2", "Y")]


def test_sinks_keep_values_or_fail(spark, scratch):
    root = scratch("exact")
    df = spark.createDataFrame([(" a ", "b\\ \"c")], "k string, v string")
    write_staging_csv(df, root + "/stg")
    assert spark.read.text(root + "/stg").where("value <> 'k,v'").first()[0] == " a ,b\\ \"c"
    export_parts(df, root + "/two")
    assert spark.read.text(root + "/two").first()[0] == " a ,b\\ \"c"
    one = spark.createDataFrame([(" x,y ",)], "value string")
    export_parts(one, root + "/one")
    assert spark.read.text(root + "/one").first()[0] == " x,y "
    comma = spark.createDataFrame([("x,y", "z")], "k string, v string")
    for write in (write_staging_csv, export_parts):
        with pytest.raises(Exception, match="separator or line break"):
            write(comma, root + "/bad")


def test_blank_paths_write_an_unpartitioned_table_only(spark, scratch):
    root = scratch("blank")
    out = _derive(spark, root, [("", "x")], ["'prt_path", "'v"])
    assert rows(spark.read.json(out), "v") == [("x",)]
    root = scratch("blank2")
    _derive(spark, root, [("p=1", "x")], ["'prt_path", "'v"])
    with pytest.raises(ValueError, match="has partitions"):
        _derive(spark, root, [("", "y")], ["'prt_path", "'v"])


def test_driven_items_precede_target_items(spark):
    config = {"classId": "c", "data_sources": {"s": {
        "target_items": [{"data_item": "t", "data_type": "string", "expr": "1"}],
        "driven_items": [{"data_item": "d", "data_type": "string", "expr": "2"}]}}}
    roles = feature_roles(feature_catalog(spark.createDataFrame([(json.dumps(config),)], "config string")))
    none = spark.createDataFrame([], "class_id string, source string, job_id string")
    lines = [r["line"] for r in role_rows(roles, none, "/data").orderBy("line_no").collect()]
    assert [line.split(",")[1] for line in lines] == ["d", "t"]


def test_role_file_names_the_exported_data(spark, scratch):
    root = scratch("roles")
    config = json.dumps({"classId": "c1", "data_sources": {"s": {
        "column_items": [{"data_item": "v", "data_type": "string"}],
        "driven_items": [{"data_item": "v", "data_type": "string"}]}}})
    spark.createDataFrame([('{"v":"a\\tb"}',)], "value string").write.text(resolve(root, "4ml.c1.s"))
    jobs.role_job(spark, root, "wh-c1_20160101_20160201_x", config, f"{root}/data", f"{root}/conf")
    named = spark.read.text(f"{root}/conf").where("value LIKE 'InputDataPath,%'").first()[0].split(",")[1]
    assert spark.read.text(named).first()[0] == '{"v":"a\\tb"}'


def test_a_session_sees_the_table_after_a_second_merge(spark, scratch):
    root = scratch("fresh")
    name = "ods.fresh_orders"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    for data in ([("1", "a")], [("2", "b")]):
        write_staging_csv(spark.createDataFrame(data, "k string, v string"), resolve(root, "stg.o"))
        jobs.merge_job(spark, root, "o", ["k"], mode="replace", catalog_name=name)
        got = rows(spark.table(name))
    assert got == [("1", "a"), ("2", "b")]
    spark.sql(f"DROP TABLE {name}")
