import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from wareflow.functions.columns import comparison_names, parse_month
from wareflow.operators.kpi import map_groups, period_deltas, read_kpi_sheet, unpivot_kpi
from wareflow.operators.report import report, report_rows, report_table, report_tree

from conftest import rows


def test_parse_month_two_digit_years(spark):
    df = spark.createDataFrame([("Jan95",), ("DEC01",), ("feb49",), ("Mar50",)], "t string")
    assert rows(df.select(parse_month(F.col("t")))) == [
        (dt.date(1950, 3, 1),), (dt.date(1995, 1, 1),), (dt.date(2001, 12, 1),),
        (dt.date(2049, 2, 1),)]


def test_comparison_names(spark):
    df = spark.createDataFrame([("score_Jan16",)], "k string")
    c = df.select(comparison_names(F.col("k")).alias("c")).select("c.*")
    assert rows(c) == [("score_Dec15", "score_Dec15", "score_Jan15")]


def test_period_deltas_respect_gaps(spark):
    d = lambda y, m: dt.date(y, m, 1)
    data = [("e", "k", d(2015, 12), 10.0), ("e", "k", d(2016, 1), 12.0),
            ("e", "k", d(2016, 3), 5.0), ("e", "k", d(2017, 1), 7.0),
            ("e", "k", d(2017, 3), 6.0)]
    df = spark.createDataFrame(data, "e string, kpi string, month date, value double")
    out = {r.month: (r.score_pp, r.score_ly, r.score_tb)
           for r in period_deltas(df, ["e"]).collect()}
    assert out[d(2016, 1)] == (2.0, 2.0, 12.0)   # prev Dec15=10, Dec15 again, no Jan15
    assert out[d(2016, 3)] == (5.0, -5.0, 5.0)   # Feb16 missing, Dec15=10
    assert out[d(2017, 1)] == (7.0, 7.0, -5.0)   # no Dec16, Jan16=12
    assert out[d(2017, 3)] == (6.0, 6.0, 1.0)    # Mar16=5


def test_sheet_reader_cuts_at_sentinel(spark, scratch):
    p = scratch("sheet")
    lines = [",,k_Jan16,k_Feb16,_,junk", "u,u,u,u,u,u", "s,s,s,s,s,s",
             "cn1,LNS_X,1,,,zz", "cn2,BJ_Y,3,4,,zz"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(p)
    wide = read_kpi_sheet(spark, p)
    assert wide.columns == ["bottler_cn", "bottler_en", "k_Jan16", "k_Feb16"]
    long = unpivot_kpi(wide)
    assert rows(long) == [("cn1", "LNS_X", "k", dt.date(2016, 1, 1), 1.0),
                          ("cn2", "BJ_Y", "k", dt.date(2016, 1, 1), 3.0),
                          ("cn2", "BJ_Y", "k", dt.date(2016, 2, 1), 4.0)]


def test_map_groups_last_wins_and_unmapped(spark):
    df = spark.createDataFrame([("LNS",), ("ZZ",), ("BJ",)], "b string")
    out = map_groups(df, {"G1": ["LNS", "BJ"], "G2": ["BJ"]}, "b")
    assert rows(out) == [("BJ", "G2"), ("LNS", "G1"), ("ZZ", None)]


SPEC = {"selector": [(":KPI", "kpi")], "dimension": [(":g", "g"), (":date", "date")],
        "metrics": [(":score", "score")]}


def test_report_and_tree(spark):
    df = spark.createDataFrame(
        [("2016-01", "A", "k", 2.0), ("2016-01", "A", "k", 1.0), ("2016-02", None, "k", 3.0)],
        "date string, g string, kpi string, score double")
    rep = report(df, [SPEC]).collect()
    assert len(rep) == 1 and rep[0].segment == "g_date"
    assert json.loads(rep[0].selector) == [["KPI", "k"]]
    tree = report_tree(report_rows(df, [SPEC]), 2).collect()[0]
    assert json.loads(tree.data) == {
        "[g, A]": {"[date, 2016-01]": {"items": [{"score": 1.0}, {"score": 2.0}]}},
        "[g, null]": {"[date, 2016-02]": {"items": [{"score": 3.0}]}}}
    flat = {"selector": [(":KPI", "kpi")], "dimension": [("A", "g")],
            "metrics": [(":score", "score")]}
    t0 = report_tree(report_rows(df, [flat]), 0).collect()[0]
    assert t0.segment == "overall"
    assert json.loads(t0.data) == {"items": [{"score": 1.0}, {"score": 2.0}]}


def test_tree_keys_that_print_alike_share_a_node(spark):
    df = spark.createDataFrame([("1", None, "k", 2.0), ("1", "null", "k", 1.0), ("1", 'a "b"\n', "k", None)],
                               "date string, g string, kpi string, score double")
    tree = report_tree(report_rows(df, [SPEC]), 2).collect()[0]
    assert json.loads(tree.data) == {"[g, null]": {"[date, 1]": {"items": [{"score": 1.0}, {"score": 2.0}]}},
                                     '[g, a "b"\n]': {"[date, 1]": {"items": [{"score": None}]}}}


def test_specs_with_different_metrics_share_documents(spark):
    df = spark.createDataFrame([("1", "A", "k", 2.0), ("2", "A", "k", 1.0)], "date string, g string, kpi string, score double")
    other = {**SPEC, "metrics": [(":kind", "kpi"), (":score", "score")]}
    data, = [json.loads(r.data) for r in report_table(df, [SPEC, other]).collect()]
    assert data == {"[g, A]": {f"[date, {d}]": {"items": [{"kind": "k", "score": s}, {"score": s}]} for d, s in (("1", 2.0), ("2", 1.0))}}
    items, = [r["items"] for r in report(df, [SPEC, other]).collect()]
    assert sorted(json.loads(x.metrics).keys().__len__() for x in items) == [1, 1, 2, 2]
    flat = {**SPEC, "dimension": [], "metrics": [(":n", "score")]}      # another depth is another segment
    assert {r.name for r in report_table(df, [SPEC, other, flat]).collect()} == {"g_date", "overall"}


def test_oversized_documents_fail_before_they_are_gathered(spark):
    df = spark.range(3000).selectExpr("cast(id % 7 as string) date", "'A' g", "if(id < 2900, 'hot', 'k') kpi", "cast(id as double) score")
    with pytest.raises(ValueError, match="hot"):
        report_tree(report_rows(df, [SPEC]), 2, max_bytes=20_000)
    with pytest.raises(ValueError, match="hot"):
        report(df, [SPEC], max_bytes=20_000)
    assert report_tree(report_rows(df, [SPEC]), 2, max_bytes=100_000).count() == 2


def test_raw_rows_of_one_selector_are_spread(spark):
    """The only grouping of raw rows is on the whole path; the next ones see one row a node."""
    df = spark.range(20_000).selectExpr("cast(id % 400 as string) date", "cast(id % 50 as string) g", "'one' kpi", "cast(id as double) score")
    out = report_tree(report_rows(df, [SPEC]), 2)
    out.collect()
    plan = out._jdf.queryExecution().toString()
    raw = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert raw and not any("REPARTITION" in x for x in raw)
    assert any("_k0" in x and "_k1" in x for x in raw)


def test_long_sheet_reader_equals_wide_then_unpivot(spark, scratch):
    from wareflow.operators.kpi import read_kpi_sheet_long
    p = scratch("sheet2")
    lines = [",,k_Jan16,k_Feb16,j_Dec15,_,junk", "u,u,u,u,u,u,u", "s,s,s,s,s,s,s",
             "cn1,LNS_X,1,,7,,zz", "cn2,BJ_Y,3,4,,,zz"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(p)
    assert rows(read_kpi_sheet_long(spark, p)) == rows(unpivot_kpi(read_kpi_sheet(spark, p)))


def test_sheet_lines_are_not_shuffled(spark, scratch):
    from wareflow.operators.kpi import read_kpi_sheet_long
    p = scratch("sheet3")
    lines = [",,k_Jan16,_", "u,u,u,u", "s,s,s,s", *(f"cn{i},LNS_X,{i}," for i in range(40))]
    for part in "ab":
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{p}/{part}")
    out = read_kpi_sheet_long(spark, p)
    assert out.count() == 80
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and plan.count("FileScan") == 1


def test_group_mapping_over_a_bound_is_shuffled(spark, monkeypatch):
    from wareflow.operators import kpi
    df = spark.createDataFrame([("LNS",), ("ZZ",)], "b string")
    groups = spark.createDataFrame([("LNS", "G" * 100)], "member string, group string")
    hints = []
    monkeypatch.setattr(kpi.F, "broadcast", lambda x: hints.append(x) or x)
    for bytes_max, times in ((256, 1), (100, 0)):
        monkeypatch.setattr(kpi, "MAX_BROADCAST_GROUP_BYTES", bytes_max)
        hints.clear()
        assert rows(map_groups(df, groups, "b")) == [("LNS", "G" * 100), ("ZZ", None)]
        assert len(hints) == times


def test_duplicate_sheet_entities_rejected(spark):
    d = dt.date(2016, 1, 1)
    df = spark.createDataFrame([("e", "k", d, 1.0), ("e", "k", d, 2.0)],
                               "e string, kpi string, month date, value double")
    with pytest.raises(ValueError):
        period_deltas(df, ["e"], check_unique=True)
    assert period_deltas(df.limit(1), ["e"], check_unique=True).count() == 1
