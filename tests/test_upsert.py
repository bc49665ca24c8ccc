from hypothesis import given, settings
from hypothesis import strategies as st

from wareflow.operators.upsert import replace_into, upsert

from conftest import rows

SCHEMA = "k string, v string"


def brute_full_outer(stg, ods):
    """The reference semantics: pair join on key, staging row wins whole."""
    out = []
    norm = lambda k: "" if k is None else k
    skeys = {norm(k) for k, _ in stg}
    okeys = {norm(k) for k, _ in ods}
    for s in stg:
        n = sum(1 for o in ods if norm(o[0]) == norm(s[0]))
        out += [s] * max(n, 1)
    out += [o for o in ods if norm(o[0]) not in skeys]
    assert okeys is not None
    return sorted(out, key=lambda r: (str(r[0]), str(r[1])))


def _sorted(rs):
    return sorted(rs, key=lambda r: (str(r[0]), str(r[1])))


def test_fanout_m_by_n(spark):
    stg = [("a", "s1"), ("a", "s2"), ("b", "s3")]
    ods = [("a", "o1"), ("a", "o2"), ("a", "o3"), ("c", "o4")]
    out = upsert(spark.createDataFrame(stg, SCHEMA), spark.createDataFrame(ods, SCHEMA), ["k"])
    got = _sorted([tuple(r) for r in out.collect()])
    assert got == brute_full_outer(stg, ods)
    assert len(got) == 2 * 3 + 1 + 1


def test_null_and_empty_keys_match(spark):
    stg = [(None, "s")]
    ods = [("", "o"), ("x", "o2")]
    out = upsert(spark.createDataFrame(stg, SCHEMA), spark.createDataFrame(ods, SCHEMA), ["k"])
    assert _sorted([tuple(r) for r in out.collect()]) == _sorted([(None, "s"), ("x", "o2")])


def test_numeric_null_keys(spark):
    schema = "k bigint, v string"
    stg = spark.createDataFrame([(None, "s"), (1, "s1")], schema)
    ods = spark.createDataFrame([(None, "o"), (0, "o0"), (1, "o1")], schema)
    # NULL matches NULL, not 0
    got = sorted([tuple(r) for r in upsert(stg, ods, ["k"]).collect()], key=str)
    assert got == sorted([(None, "s"), (0, "o0"), (1, "s1")], key=str)


def test_composite_key(spark):
    schema = "a string, b string, v string"
    stg = spark.createDataFrame([("1", None, "s"), ("2", "x", "s2")], schema)
    ods = spark.createDataFrame([("1", "", "o"), ("1", "y", "o1"), ("2", "x", "o2")], schema)
    got = sorted([tuple(r) for r in upsert(stg, ods, ["a", "b"]).collect()], key=str)
    assert got == sorted([("1", None, "s"), ("1", "y", "o1"), ("2", "x", "s2")], key=str)


keys = st.sampled_from(["a", "b", "c", "d", None, ""])


@settings(max_examples=15, deadline=None)
@given(st.lists(keys, max_size=6), st.lists(keys, max_size=6, unique_by=lambda k: k or ""))
def test_join_equals_replace_when_stored_keys_unique(spark, skeys, okeys):
    stg = [(k, f"s{i}") for i, k in enumerate(skeys)]
    ods = [(k, f"o{i}") for i, k in enumerate(okeys)]
    sdf, odf = spark.createDataFrame(stg, SCHEMA), spark.createDataFrame(ods, SCHEMA)
    j = _sorted([tuple(r) for r in upsert(sdf, odf, ["k"], "join").collect()])
    r = _sorted([tuple(r) for r in upsert(sdf, odf, ["k"], "replace").collect()])
    assert j == r == brute_full_outer(stg, ods)


@settings(max_examples=10, deadline=None)
@given(st.lists(keys, max_size=6), st.lists(keys, max_size=6))
def test_join_mode_matches_brute_force(spark, skeys, okeys):
    stg = [(k, f"s{i}") for i, k in enumerate(skeys)]
    ods = [(k, f"o{i}") for i, k in enumerate(okeys)]
    sdf, odf = spark.createDataFrame(stg, SCHEMA), spark.createDataFrame(ods, SCHEMA)
    for bound in (None, 1_000):  # shuffle plan, measured-broadcast plan
        out = upsert(sdf, odf, ["k"], broadcast_keys_max=bound)
        assert _sorted([tuple(r) for r in out.collect()]) == brute_full_outer(stg, ods)


def test_replace_into_last_wins(spark):
    existing = spark.createDataFrame([("n", "c", "s1", "old"), ("n", "c", "s2", "keep")],
                                     "name string, category string, selector string, data string")
    incoming = spark.createDataFrame(
        [("n", "c", "s1", "new1", 1), ("n", "c", "s1", "new2", 2), ("n", "c", "s3", "add", 1)],
        "name string, category string, selector string, data string, seq int")
    out = replace_into(existing, incoming, ["name", "category", "selector"], order_by=["seq"])
    assert rows(out) == [("n", "c", "s1", "new2"), ("n", "c", "s2", "keep"),
                         ("n", "c", "s3", "add")]


def test_replace_into_keeps_one_row_per_blank_key(spark):
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([(None, 2), ("", 3), ("a", 4)], "k string, v int")
    out = replace_into(old, new, ["k"], order_by=["v"])
    assert sorted((r.k or "", r.v) for r in out.collect()) == [("", 3), ("a", 4)]


def test_added_columns_fail_or_are_added(spark):
    import pytest
    stg = spark.createDataFrame([("1", "A", "n")], "k string, v string, extra string")
    ods = spark.createDataFrame([("1", "a"), ("2", "b")], "k string, v string")
    with pytest.raises(ValueError, match="extra"):
        upsert(stg, ods, ["k"])
    for mode in ("join", "replace"):
        got = upsert(stg, ods, ["k"], mode=mode, new_columns="add")
        assert sorted(map(tuple, got.collect())) == [("1", "A", "n"), ("2", "b", None)]
    with pytest.raises(ValueError, match="lacks the stored columns"):
        upsert(stg.drop("v", "extra"), ods, ["k"])


def test_fan_out_beyond_one_chunk(spark, monkeypatch):
    from wareflow.operators import upsert as module
    monkeypatch.setattr(module, "FAN_OUT", 4)
    for n in (1, 4, 5, 13):
        ods = spark.range(n).selectExpr("'1' AS k", "CAST(id AS STRING) AS v")
        got = upsert(spark.createDataFrame([("1", "x"), ("2", "y")], "k string, v string"), ods, ["k"])
        assert {(r["k"], r["v"]): r["count"] for r in got.groupBy("k", "v").count().collect()} == {("1", "x"): n, ("2", "y"): 1}


def test_staging_keys_beyond_a_small_table_are_shuffled(spark):
    """A broadcast table is held by every task, so its size must not follow the staging drop."""
    from pyspark.sql import functions as F
    stg = spark.range(1_100_000).select(F.col("id").alias("k"), F.lit("s").alias("v"))
    ods = spark.range(1_000_000, 1_300_000).select(F.col("id").alias("k"), F.lit("o").alias("v"))
    out = upsert(stg, ods, ["k"])
    assert "strategy=broadcast" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r.v: r["count"] for r in out.groupBy("v").count().collect()} == {"s": 1_100_000, "o": 200_000}
    few = upsert(stg.limit(10), ods, ["k"])
    assert "strategy=broadcast" in few._jdf.queryExecution().optimizedPlan().toString()
