"""Tables whose rows name different lists of levels, and files whose headers differ."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareflow.functions.columns import bind_fields, filled_names
from wareflow.functions.spec import resolve
from wareflow.plans import jobs
from wareflow.sinks import layouts
from wareflow.sinks.files import write_delimited, write_staging_csv
from wareflow.sinks.layouts import layout_folder, read_feature_table, stored_layouts
from wareflow.sources.text import check_headers, first_lines, read_bound, read_data_lines, read_staging

from conftest import rows

SCHEMA = T.StructType([T.StructField("v", T.DoubleType())])


def derive(spark, root, pairs, tag="s"):
    source = spark.createDataFrame(pairs, "prt_path string, v string")
    write_delimited(source, resolve(root, f"model.{tag}"))
    return jobs.derive_job(spark, root, f"model.{tag}", "4ml.t", ["'_prt_path", "v"], [])


def stored(spark, path, *cols):
    return rows(read_feature_table(spark, path, SCHEMA), *cols)


def test_layouts_of_one_run_and_of_several(spark, scratch):
    root = scratch("lay")
    path = derive(spark, root, [("p=1", "1"), ("p=2", "2")])
    assert stored_layouts(spark, path) == [(path, ["p"])] and stored(spark, path, "v", "p") == [(1.0, "1"), (2.0, "2")]
    derive(spark, root, [("q=1", "3"), ("p=1/q=x", "4"), ("p=2", "5")], "s2")      # p=2 is replaced, p=1 stays
    assert sorted(n for _, n in stored_layouts(spark, path)) == [["p"], ["p", "q"], ["q"]]
    want = [(1.0, "1", None), (3.0, None, "1"), (4.0, "1", "x"), (5.0, "2", None)]
    assert stored(spark, path, "v", "p", "q") == want
    derive(spark, root, [("q=1", "6"), ("q=2", "7")], "s3")                        # one layout, not the home one
    assert stored(spark, path, "v", "p", "q") == want[:1] + want[2:] + [(6.0, None, "1"), (7.0, None, "2")]
    with pytest.raises(ValueError, match="has partitions"):
        derive(spark, root, [("", "8")], "s4")


def test_blank_paths_and_odd_names(spark, scratch):
    root = scratch("odd")
    path = derive(spark, root, [("a.b=1/c d=x%", "1"), ("e=2", "2"), ("", "3")])
    assert sorted(n for _, n in stored_layouts(spark, path)) == [["a.b", "c d"], ["e"]]
    assert stored(spark, path, "v", "`a.b`", "`c d`", "e") == [(1.0, "1", "x%", None), (2.0, None, None, "2"), (3.0, None, None, None)]
    assert layout_folder(["a.b", "c d"]) == "levels.a%2Eb.c%20d"


@pytest.mark.parametrize("fail_at", ["before", "half"])
def test_a_run_that_died_is_finished_by_the_next(spark, scratch, monkeypatch, fail_at):
    root = scratch("died")
    path = derive(spark, root, [("p=1", "1"), ("q=1", "2")])
    real, seen = layouts.finish_layouts, []

    def dies(s, p):
        seen.append(p)
        if len(seen) == 1:                                  # at the start of write_layouts: nothing to finish
            return real(s, p)
        if fail_at == "half":
            fs, at = layouts._fs(s, f"{path}__ready/levels.p/p=1")
            target = s._jvm.org.apache.hadoop.fs.Path(f"{path}/p=1")
            fs.delete(target, True)
            assert fs.rename(at, target)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(layouts, "finish_layouts", dies)
        with pytest.raises(RuntimeError):
            derive(spark, root, [("p=1", "3"), ("q=1", "4"), ("q=2", "5")], "s2")
    derive(spark, root, [("p=9", "9"), ("q=9", "9")], "s3")
    assert stored(spark, path, "v", "p", "q") == [(3.0, "1", None), (4.0, None, "1"), (5.0, None, "2"), (9.0, "9", None), (9.0, None, "9")]


def _put(spark, path, *lines, **options):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.options(**options).text(path)


def test_first_lines_alone_are_read(spark, scratch):
    p = scratch("heads")
    _put(spark, p + "/a", "k,v", *("x" * 200 for _ in range(5000)))
    _put(spark, p + "/b/c", "k,v")
    _put(spark, p + "/z", "k,w", "1,2", compression="gzip")
    _put(spark, p + "/long", "k" * 200_000, "1")
    assert sorted(r.line for r in first_lines(spark, p).collect()) == sorted(["k,v", "k,v", "k,w", "k" * 200_000])
    assert rows(check_headers(spark, p)) == [(4, 3)]
    with pytest.raises(ValueError, match="header"):
        read_staging(spark, p, strict_single_file=True)


def test_unknown_schemes_fall_back_to_the_line_reader(spark, scratch, monkeypatch):
    from wareflow.sources import text
    p = scratch("heads2")
    _put(spark, p + "/a", "k,v", "1,2")
    _put(spark, p + "/b", "k,w", "1,2")
    monkeypatch.setattr(text, "OPENED_SCHEMES", ())
    assert rows(check_headers(spark, p)) == [(2, 2)]


@pytest.mark.parametrize("header", ["k, ,v", "k,  ,v", "k,\t,v", "k,,v"])
def test_blank_header_names(spark, scratch, header):
    p = scratch("blank")
    _put(spark, p + "/a", header, "1,2,3")
    _put(spark, p + "/b", header, "4,,6")
    got = read_staging(spark, p)
    assert got.columns == ["k", "NA_2", "v"] and rows(got) == [("1", "2", "3"), ("4", None, "6")]
    _put(spark, p + "/c", "k,w,v", "7,8,9")
    with pytest.raises(Exception, match="(?i)header"):
        read_staging(spark, p).collect()


def test_a_column_called_like_spark_names_blank_ones(spark, scratch):
    p = scratch("c1")
    _put(spark, p, "k,_c1,", "1,2,3")
    assert read_staging(spark, p).columns == ["k", "_c1", "NA_3"]


def test_partition_job_with_blank_names(spark, scratch):
    root = scratch("pblank")
    _put(spark, resolve(root, "stg.t"), "k, ,p", "1,a,x", "2,b,y")
    name = "ods.blank_" + root.rsplit("-", 1)[-1]
    jobs.partition_job(spark, root, "t", [[":pp", 2]], catalog_name=name)
    assert rows(spark.table(name), "prt_path", "k", "NA_2", "p", "pp") == [("pp=x", "1", "a", "x", "x"), ("pp=y", "2", "b", "y", "y")]


def test_strict_single_file_jobs(spark, scratch):
    root = scratch("strict")
    df = spark.createDataFrame([("1", "a")], "k string, v string").coalesce(1)
    write_staging_csv(df, resolve(root, "stg.t") + "/a")
    name = "ods.strict_" + root.rsplit("-", 1)[-1]
    jobs.merge_job(spark, root, "t", ["k"], catalog_name=name, strict_single_file=True)
    write_staging_csv(df, resolve(root, "stg.t") + "/b")
    for job in (lambda: jobs.merge_job(spark, root, "t", ["k"], catalog_name=name, strict_single_file=True),
                lambda: jobs.partition_job(spark, root, "t", [[":p", 1]], catalog_name=name, strict_single_file=True)):
        with pytest.raises(ValueError, match="header"):
            job()


def test_skipped_lines_of_many_files_in_a_task(spark, scratch):
    p = scratch("many")
    want = []
    for i in range(12):
        lines = [f"h{j}" for j in range(3)] + [f"{i}-{j}" for j in range(i * 7)]
        _put(spark, f"{p}/{i}", *lines[:2 if i == 5 else None])             # a file of fewer lines than are skipped
        want += lines[3:] if i != 5 else []
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for size in ("2", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        got = read_data_lines(spark, p, 3)
        assert sorted(r.value for r in got.collect()) == sorted(want)
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_headers_bound_to_fields_by_position(spark, scratch):
    p = scratch("bound")
    _put(spark, p + "/a", "k,v", "1,2", "3", "4,5,6", "")
    _put(spark, p + "/b", "v,,k", "a,b,c")
    got = read_bound(spark, p).select(F.transform("fields", lambda f: F.concat_ws("=", f["name"], F.coalesce(f["value"], F.lit("-")))).alias("f"))
    assert sorted(r.f for r in got.collect()) == [["k=1", "v=2"], ["k=3", "v=-"], ["k=4", "v=5"], ["v=a", "NA_2=b", "k=c"]]
    one = spark.createDataFrame([(["a", " ", None], ["1"])], "n array<string>, f array<string>")
    (r,) = one.select(bind_fields(filled_names(F.col("n")), F.col("f")).alias("b")).collect()
    assert [(x["name"], x["value"]) for x in r.b] == [("a", "1"), ("NA_2", None), ("NA_3", None)]
