"""Hot keys (a third of all rows on one key) are split, not funnelled."""

import contextlib

from pyspark.sql import functions as F

from wareflow.operators.edges import invert
from wareflow.operators.upsert import replace_into, upsert

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@contextlib.contextmanager
def conf(spark, settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_upsert_splits_hot_keys_on_both_joins(spark):
    n = 90000
    # nullable keys, as read from files (a NULL key is its own key)
    ods = spark.range(n).select(
        F.when(F.col("id") == 5, F.lit(None))
         .when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") + 10).alias("k"),
        F.col("id").cast("string").alias("v"))
    stg = spark.range(n).select(
        F.when(F.col("id") == 4, F.lit(None))
         .when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") + 2 * n).alias("k"),
        F.concat(F.col("id").cast("string"), F.lit("s")).alias("v"))
    with conf(spark, SKEW_CONF):
        out = upsert(stg, ods, ["k"], broadcast_keys_max=None)  # the shuffle plan
        assert len(out.collect()) == 2 * n - 1  # the NULL-key stored row is replaced
        plan = _final_plan(out)
    # the anti join (stored side hot) and the count join (staging side hot)
    assert plan.count("SortMergeJoin(skew=true)") >= 2
    assert plan.count("AQEShuffleRead skewed") >= 2


def test_hot_key_fanout_is_exact(spark):
    ods = spark.range(3000).select(F.lit(7).cast("bigint").alias("k"),
                                   F.col("id").cast("string").alias("v"))
    stg = spark.createDataFrame([(7, "a"), (7, "b"), (8, "c")], "k bigint, v string")
    for bound in (None, 10):  # shuffle plan, measured-broadcast plan
        with conf(spark, SKEW_CONF):
            got = upsert(stg, ods, ["k"], broadcast_keys_max=bound).groupBy("v").count().collect()
        assert sorted((r.v, r["count"]) for r in got) == [("a", 3000), ("b", 3000), ("c", 1)]


def test_few_staging_keys_never_shuffle_the_stored_side(spark):
    ods = spark.range(50000).select((F.col("id") % 5000).alias("k"),
                                    F.col("id").cast("string").alias("v"))
    stg = spark.createDataFrame([(1, "s"), (2, "t"), (999999, "new")], "k bigint, v string")
    with conf(spark, SKEW_CONF):
        small = upsert(stg, ods, ["k"], broadcast_keys_max=100)
        big = upsert(stg, ods, ["k"], broadcast_keys_max=None)
        got = sorted(tuple(r) for r in small.collect())
        assert got == sorted(tuple(r) for r in big.collect())
        plan = _final_plan(small)
    assert "SortMergeJoin" not in plan
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "LeftSemi" in plan
    assert len(got) == 50000 - 20 + 2 * 10 + 1


def test_replace_into_reduces_hot_key_map_side(spark):
    existing = spark.createDataFrame([(0, "old")], "k bigint, v string")
    incoming = spark.range(60000).select(F.lit(0).cast("bigint").alias("k"),
                                         F.col("id").cast("string").alias("v"),
                                         F.col("id").alias("seq"))
    out = replace_into(existing, incoming, ["k"], order_by=["seq"])
    assert [tuple(r) for r in out.collect()] == [(0, "59999")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan  # combined per task before the shuffle


def test_invert_splits_hot_node(spark):
    edges = spark.range(60000).select(F.col("id").cast("string").alias("parent"),
                                      F.when(F.col("id") % 3 == 0, F.lit("hot"))
                                      .otherwise(F.col("id").cast("string")).alias("child"))
    with conf(spark, SKEW_CONF):
        out = invert(edges)
        got = out.collect()
        assert len(got) == 60000
        assert {r.n_parents for r in got if r.node == "hot"} == {20000}
        plan = _final_plan(out)
    assert "SortMergeJoin(skew=true)" in plan  # the hot node's edges are split


def test_copies_of_one_row_are_made_by_many_tasks(spark):
    ods = spark.range(3_000_000).select(F.lit(7).cast("bigint").alias("k"), F.lit("v").alias("v"))
    stg = spark.createDataFrame([(7, "a"), (8, "b")], "k bigint, v string")
    for bound in (None, 10):
        with conf(spark, {**SKEW_CONF, "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
            out = upsert(stg, ods, ["k"], broadcast_keys_max=bound).where("v = 'a'")
            got = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(r["count"] for r in got) == 3_000_000 and len(got) >= 8
        assert max(r["count"] for r in got) <= 800_000


def test_broadcast_bound_counts_rows_and_table(spark):
    from wareflow.operators.measure import fits_broadcast, measured
    df = spark.createDataFrame([("a" * 100, 1), (None, 2)], "k string, v bigint")
    rows_, size = measured(df)
    assert rows_ == 2 and 2 * 48 + 100 < size < 400
    assert fits_broadcast(df, 2, size) and not fits_broadcast(df, 1, size)
    assert not fits_broadcast(df, 2, size - 1) and not fits_broadcast(df, None)
    assert fits_broadcast(df.limit(0), 1, 0)
