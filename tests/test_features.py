import json

from wareflow.operators.features import (columns_for, exprs_for, feature_catalog, feature_roles,
                                         parse_job_id, role_rows)
from pyspark.sql import functions as F

from conftest import rows

# A config in the documented shape, with a column list.
SAMPLE = {"classId": "footfall", "data_sources": {"d_visits": {
    "column_items": [{"data_type": "string", "data_item": "shop"},
                     {"data_type": "date", "data_item": "opened"},
                     {"data_type": "number", "data_item": "visits"},
                     {"data_type": "number", "data_item": "extra"}],
    "driven_items": [{"data_type": "string", "data_item": "shop"},
                     {"data_type": "string", "data_item": "busy",
                      "expr": ":visits >= 250 && :extra < 3 "},
                     {"data_type": "string", "data_item": "visits"}],
    "target_items": [{"data_type": "string", "data_item": "shopCap",
                      "expr": ":shop != 'x' || :visits == 0 "}]}}}


def _cat(spark, doc=SAMPLE, prefer="classified_id"):
    return feature_catalog(spark.createDataFrame([(json.dumps(doc),)], "config string"),
                           prefer=prefer)


def test_catalog_and_id_fallback(spark):
    cat = _cat(spark)
    assert cat.count() == 8
    assert rows(cat.select("class_id").distinct()) == [("footfall",)]
    both = dict(SAMPLE, classified_id="other")
    assert rows(_cat(spark, both).select("class_id").distinct()) == [("other",)]
    assert rows(_cat(spark, both, "classId").select("class_id").distinct()) == [("footfall",)]


def test_columns_markers(spark):
    out = columns_for(_cat(spark)).orderBy("pos").select("column_marker").collect()
    assert [r[0] for r in out] == ["'prt_path", "'shop", "'_opened", "visits", "_extra"]


def test_exprs_in_list_order(spark):
    out = exprs_for(_cat(spark)).orderBy("list_pos", "pos").select("target", "body").collect()
    assert [tuple(r) for r in out] == [(":busy", ":visits >= 250 && :extra < 3 "),
                                        (":shopCap", ":shop != 'x' || :visits == 0 ")]


def test_roles(spark):
    out = rows(feature_roles(_cat(spark)), "role", "data_item", "data_type")
    # visits is declared as number but driven as string: the pair does not intersect
    assert out == [("InputCol", "busy", "string"), ("InputCol", "shop", "string"),
                   ("TargetCol", "shopCap", "string")]


def test_role_rows_and_job_id(spark):
    cat = _cat(spark)
    jobs = cat.select("class_id", "source").distinct().withColumn(
        "job_id", F.lit("wh-footfall_20161001_20161031_roleJob"))
    out = role_rows(feature_roles(cat), jobs, "/data").orderBy("line_no").collect()
    assert [r.line for r in out] == [
        "InputCol,shop,string", "InputCol,busy,string", "TargetCol,shopCap,string",
        "PredStartDate,20161001,Date", "PredEndDate,20161031,Date",
        "InputDataPath,/data/in/footfall/d_visits/data.csv,string",
        "OutDataPath,/data/out/footfall/data.csv,string"]
    p = spark.createDataFrame([("wh-c1_20160101_20160201_x",)], "j string").select(
        parse_job_id(F.col("j")).alias("p")).select("p.*")
    assert rows(p) == [("c1", "20160101", "20160201")]


def test_role_files_one_per_config_in_order(spark, scratch):
    from wareflow.operators.features import write_role_files
    from wareflow.sources.text import read_lines
    docs = [json.dumps(dict(SAMPLE, classId=f"m{i}")) for i in range(3)]
    cat = feature_catalog(spark.createDataFrame([(d,) for d in docs], "config string"))
    jobs = cat.select("class_id", "source").distinct().withColumn(
        "job_id", F.concat(F.lit("wh-"), F.col("class_id"), F.lit("_20160101_20160131_x")))
    p = scratch("roles")
    write_role_files(role_rows(feature_roles(cat), jobs, "/d"), p)
    got = read_lines(spark, p, with_file=True).collect()
    by_file = {}
    for r in got:
        by_file.setdefault(r.file_path, []).append(r.value)
    assert len(by_file) == 3
    for lines in by_file.values():
        assert lines[:3] == ["InputCol,shop,string", "InputCol,busy,string", "TargetCol,shopCap,string"]
        assert lines[3].startswith("PredStartDate,20160101") and lines[6].startswith("OutDataPath")


def test_spec_lists_for_one_config(spark):
    from wareflow.operators.features import spec_lists
    cols, exprs = spec_lists(_cat(spark), "footfall", "d_visits")
    assert cols == ["'prt_path", "'shop", "'_opened", "visits", "_extra"]
    assert exprs == [(":busy", ":visits >= 250 && :extra < 3 "), (":shopCap", ":shop != 'x' || :visits == 0 ")]
