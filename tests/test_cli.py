import json

from wareflow.functions.spec import resolve
from wareflow.plans.cli import build_parser, run
from wareflow.sinks.files import write_staging_csv

from conftest import rows


def test_cli_merge_partition_and_kpi(spark, scratch):
    root = scratch("cli")
    tag = root.rsplit("-", 1)[-1]
    merged, parted = f"m{tag}", f"p{tag}"  # catalog names ods.<table> are per table
    df = spark.createDataFrame([("1", "a", "d1"), ("2", "b", "d2")], "k string, v string, d string")
    write_staging_csv(df, resolve(root, f"stg.{merged}"))
    write_staging_csv(df, resolve(root, f"stg.{parted}"))
    p = build_parser()
    out = run(p.parse_args(["--root", root, "merge", merged, '[[":k", 0]]']), spark)
    assert rows(spark.read.parquet(out)) == [("1", "a", "d1"), ("2", "b", "d2")]
    out = run(p.parse_args(["--root", root, "--format", "delimited", "partition", parted,
                            '[[":p_d", 2]]']), spark)
    assert len(spark.read.option("recursiveFileLookup", "true").text(out).collect()) == 2

    sheet = scratch("cli_sheet")
    lines = [",,k_Jan16,k_Feb16,_", "u,u,u,u,u", "s,s,s,s,s", "cn,LNS_X,1,2,"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(sheet)
    spec = [{"selector": [[":KPI", 4]], "dimension": [[":date", 0]], "metrics": [[":score", 5]]}]
    target = scratch("cli_report")
    run(p.parse_args(["kpi", sheet, target, json.dumps({"G": ["LNS"]}), json.dumps(spec)]), spark)
    got = spark.read.parquet(target).collect()
    assert [(r.name, r.selector) for r in got] == [("date", '[["KPI","k"]]')]
    assert json.loads(got[0].data) == {"[date, 2016-01]": {"items": [{"score": 1.0}]},
                                       "[date, 2016-02]": {"items": [{"score": 2.0}]}}
