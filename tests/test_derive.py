import pytest
from pyspark.sql import functions as F

from wareflow.operators.derive import apply_spec, bind_types, derive

from conftest import rows


def test_hidden_inputs_and_sequence(spark):
    df = spark.createDataFrame([("p=1", "10", "4"), ("p=1", "2", "7"), ("p=2", "30", "0")],
                               "prt_path string, width string, gap string")
    out = apply_spec(df, ["'prt_path", "_width", "gap"],
                     [(":inner", ":width - 2 * :gap"), (":tight", ":inner < 0"), (":odd", ":tight || :gap == 0")])
    assert out.columns == ["prt_path", "gap", "inner", "tight", "odd"]
    assert rows(out) == [("p=1", 4.0, 2.0, False, False), ("p=1", 7.0, -12.0, True, True),
                         ("p=2", 0.0, 30.0, False, True)]


def test_targets_that_differ_in_case_fail(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    with pytest.raises(ValueError, match="case"):
        derive(df, [(":A", ":a * 10"), (":b", ":a + 1")])
    with pytest.raises(ValueError, match="case"):
        derive(df, [(":x", ":a"), (":X", ":a")])


def test_reassigned_column_is_seen_by_later_exprs(spark):
    df = spark.createDataFrame([(3.0,)], "a double")
    out = derive(df, [(":a", ":a * 2"), (":b", ":a + 1")])
    assert rows(out) == [(6.0, 7.0)]  # not (6, 4): b sees the new a


def test_independent_exprs_batched_same_result(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    out = derive(df, [(":x", ":a + 1"), (":y", ":b + 1"), (":z", ":x + :y")])
    assert rows(out) == [(1.0, 2.0, 2.0, 3.0, 5.0)]


def test_or_is_logical(spark):
    df = spark.createDataFrame([(True, False)], "p boolean, q boolean")
    assert rows(derive(df, [(":r", ":p || :q")]), "r") == [(True,)]


def test_bad_number_fails_or_nulls(spark):
    df = spark.createDataFrame([("1",), ("x",)], "n string")
    with pytest.raises(Exception):
        bind_types(df, ["n"]).collect()
    assert rows(bind_types(df, ["n"], on_bad_number="null")) == [(1.0,), (None,)]


def test_types(spark):
    df = spark.createDataFrame([("5", "5.5", "x")], "a string, b string, c string")
    out = bind_types(df, ["a", "b", "'c"])
    assert dict(out.dtypes) == {"a": "double", "b": "double", "c": "string"}
    assert rows(out) == [(5.0, 5.5, "x")]


def test_udf_in_expression(spark):
    spark.udf.register("wf_twice", lambda v: v * 2, "double")
    df = spark.createDataFrame([(2.0,)], "a double")
    assert rows(derive(df, [(":b", "wf_twice(:a)")]), "b") == [(4.0,)]
    assert F  # keep import


def test_string_item_compared_with_number(spark):
    # A "string" item compared with a number: the text is cast (ANSI), and
    # malformed text fails instead of comparing as text.
    df = spark.createDataFrame([("12",), ("3",)], "num string")
    out = derive(df, [(":big", ":num > 9 || :num <= 1")])
    assert rows(out) == [("12", True), ("3", False)]
    bad = spark.createDataFrame([("x",)], "num string")
    with pytest.raises(Exception):
        derive(bad, [(":big", ":num > 9")]).collect()
