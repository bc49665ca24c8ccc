from wareflow.sinks.files import applied_batch, write_staging_csv
from wareflow.streaming.ingest import ingest_partitions, merge_batch

import pytest
from conftest import rows


def test_merge_batch_is_applied_once(spark, scratch):
    target = scratch("smerge")
    b0 = spark.createDataFrame([("1", "a"), ("2", "b")], "k string, v string")
    b1 = spark.createDataFrame([("2", "B"), ("2", "B2"), ("3", "c")], "k string, v string")
    assert merge_batch(spark, b0, 0, target, ["k"], mode="join")
    assert merge_batch(spark, b1, 1, target, ["k"], mode="join")
    once = rows(spark.read.parquet(target))
    assert once == [("1", "a"), ("2", "B"), ("2", "B2"), ("3", "c")]
    # a retried batch (same id) is skipped, so join-mode fan-out is not doubled
    assert not merge_batch(spark, b1, 1, target, ["k"], mode="join")
    assert rows(spark.read.parquet(target)) == once
    assert applied_batch(spark, target) == 1


def test_stream_picks_up_only_new_drops(spark, scratch):
    root = scratch("sdrops")
    drops, target = f"{root}/stg", f"{root}/ods"
    df = spark.createDataFrame([("1", "x"), ("2", "y")], "k string, p string")
    write_staging_csv(df, f"{drops}/d=1")
    ckpt = ingest_partitions(spark, f"{drops}/*", f"{drops}/d=1", target, [[":pp", 1]],
                             checkpoint=f"{root}/ckpt")
    write_staging_csv(spark.createDataFrame([("3", "x")], "k string, p string"), f"{drops}/d=2")
    ingest_partitions(spark, f"{drops}/*", f"{drops}/d=1", target, [[":pp", 1]], checkpoint=ckpt)
    # the second run took the second drop alone, and added its row to partition pp=x
    assert rows(spark.read.parquet(target), "k", "p", "pp") == [("1", "x", "x"), ("2", "y", "y"), ("3", "x", "x")]


@pytest.mark.parametrize("cap", [None, 1])
def test_one_run_keeps_all_rows_whatever_the_trigger(spark, scratch, cap):
    root = scratch("scap")
    for i, (k, p) in enumerate([("1", "N/A"), ("2", "y"), ("3", "N/A"), ("4", "N")]):
        write_staging_csv(spark.createDataFrame([(k, p)], "k string, p string").coalesce(1), f"{root}/stg/d={i}")
    ingest_partitions(spark, f"{root}/stg/*", f"{root}/stg/d=0", f"{root}/ods", [[":pp", 1]],
                      checkpoint=f"{root}/ckpt", max_files_per_trigger=cap)
    got = rows(spark.read.parquet(f"{root}/ods"), "k", "pp")
    assert got == [("1", "N/A"), ("2", "y"), ("3", "N/A"), ("4", "N")]


@pytest.mark.parametrize("cap", [None, 1])
def test_unpartitioned_runs_add_up(spark, scratch, cap):
    root = scratch("sflat")
    args = (f"{root}/stg/*", f"{root}/stg/d=0", f"{root}/ods")
    for run in range(2):
        for i in (2 * run, 2 * run + 1):
            write_staging_csv(spark.createDataFrame([(str(i), "x")], "k string, p string").coalesce(1), f"{root}/stg/d={i}")
        ingest_partitions(spark, *args, checkpoint=f"{root}/ckpt", max_files_per_trigger=cap)
    assert rows(spark.read.parquet(f"{root}/ods"), "k") == [("0",), ("1",), ("2",), ("3",)]
    with pytest.raises(ValueError, match="filled by stream"):
        ingest_partitions(spark, *args, checkpoint=f"{root}/other")


@pytest.mark.parametrize("step", ["write_partitioned", "move_folder", "retire_folder", "add_files"])
def test_run_that_died_while_publishing_is_finished_once(spark, scratch, monkeypatch, step):
    from wareflow.streaming import ingest
    root = scratch("sdied")
    args = (f"{root}/stg/*", f"{root}/stg/d=0", f"{root}/ods", [[":pp", 1]])
    write_staging_csv(spark.createDataFrame([("1", "x"), ("2", "y")], "k string, p string"), f"{root}/stg/d=0")
    ingest_partitions(spark, *args, checkpoint=f"{root}/ckpt")
    write_staging_csv(spark.createDataFrame([("3", "x")], "k string, p string"), f"{root}/stg/d=1")
    real, calls = getattr(ingest, step), []

    def dies(*a, **k):
        calls.append(a)
        if step == "move_folder" and len(calls) == 1:         # pending to ready: the stream has stopped by then
            return real(*a, **k)
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(ingest, step, dies)
        with pytest.raises(RuntimeError):
            ingest_partitions(spark, *args, checkpoint=f"{root}/ckpt")
    write_staging_csv(spark.createDataFrame([("4", "x")], "k string, p string"), f"{root}/stg/d=2")
    ingest_partitions(spark, *args, checkpoint=f"{root}/ckpt")
    assert rows(spark.read.parquet(f"{root}/ods"), "k", "pp") == [("1", "x"), ("2", "y"), ("3", "x"), ("4", "x")]


def test_half_moved_files_are_finished(spark, scratch):
    from wareflow.sinks.files import _fs, add_files, write_partitioned
    root = scratch("shalf")
    df = spark.range(20).selectExpr("id", "id % 5 AS p").repartition(3)
    write_partitioned(df, f"{root}/t", ["p"])
    write_partitioned(df.selectExpr("id + 100 AS id", "p"), f"{root}/s", ["p"])
    fs, at = _fs(spark, f"{root}/s/p=2/part*")
    moved = fs.globStatus(at)[0].getPath()
    fs.rename(moved, spark._jvm.org.apache.hadoop.fs.Path(f"{root}/t/p=2/{moved.getName()}"))
    add_files(spark, f"{root}/s", f"{root}/t", 1)
    assert sorted(r.id for r in spark.read.parquet(f"{root}/t").collect()) == [*range(20), *range(100, 120)]


@pytest.mark.parametrize("cuts", [[4], [1, 3], [1, 1, 1, 1]])
def test_same_table_for_any_split_into_runs(spark, scratch, cuts):
    root = scratch("ssplit")
    data = [("1", "N/A"), ("2", "y"), ("3", "N/A"), ("4", "y")]
    args = (f"{root}/stg/*", f"{root}/stg/d=0", f"{root}/ods", [[":pp", 1]])
    at = 0
    for n in cuts:
        for i in range(at, at + n):
            write_staging_csv(spark.createDataFrame([data[i]], "k string, p string").coalesce(1), f"{root}/stg/d={i}")
        at += n
        ingest_partitions(spark, *args, checkpoint=f"{root}/ckpt", max_files_per_trigger=1)
    assert rows(spark.read.parquet(f"{root}/ods"), "k", "pp") == data[:1] + [("2", "y"), ("3", "N/A"), ("4", "y")]


def test_blank_names_of_a_sample_drop(spark, scratch):
    root = scratch("sblank")
    spark.createDataFrame([("k,, ,p",), ("1,a,b,x",)], "v string").coalesce(1).write.text(f"{root}/stg/d=0")
    ingest_partitions(spark, f"{root}/stg/*", f"{root}/stg/d=0", f"{root}/ods", [[":pp", 3]], checkpoint=f"{root}/ckpt")
    assert rows(spark.read.parquet(f"{root}/ods"), "k", "NA_2", "NA_3", "p", "pp") == [("1", "a", "b", "x", "x")]


def test_drop_with_another_header_order_fails(spark, scratch):
    root = scratch("shead")
    write_staging_csv(spark.createDataFrame([("1", "x")], "k string, p string"), f"{root}/stg/d=0")
    write_staging_csv(spark.createDataFrame([("y", "2")], "p string, k string"), f"{root}/stg/d=1")
    with pytest.raises(Exception, match="CSV header"):
        ingest_partitions(spark, f"{root}/stg/*", f"{root}/stg/d=0", f"{root}/ods", [[":pp", 1]],
                          checkpoint=f"{root}/ckpt")


def test_merge_batch_refuses_another_streams_table(spark, scratch):
    target = scratch("sforeign")
    b0 = spark.createDataFrame([("1", "a")], "k string, v string")
    assert merge_batch(spark, b0, 5, target, ["k"], stream_id="one")
    with pytest.raises(ValueError, match="filled by stream"):
        merge_batch(spark, b0, 0, target, ["k"], stream_id="two")
