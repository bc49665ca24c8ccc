"""Command line for the composite jobs, for schedulers that launch commands.

    spark-submit wareflow/plans/cli.py --root /warehouse merge d_orders '[[":order_id", 0]]'
    spark-submit wareflow/plans/cli.py --root /warehouse partition d_dau '[[":p_date", 1]]'
    spark-submit wareflow/plans/cli.py --root /warehouse derive model.d_orders 4ml.x.d_orders \\
        '["\\u0027prt_path", "quantity", "_price"]' '[[":big", ":quantity > 9"]]'
    spark-submit wareflow/plans/cli.py --root /warehouse feature '<config json>'
    spark-submit wareflow/plans/cli.py --root /warehouse role <job_id> '<config json>' \\
        --data-root /handoff --conf-path /handoff/conf/<job_id>
    spark-submit wareflow/plans/cli.py kpi <sheet path> <report table path> '<groups json>' '<specs json>'

Specs are JSON text: key and partition specs are ``[[":name", index], ...]``,
column specs are marker lists, expressions ``[[":target", "body"], ...]``,
report specs a list of ``{"selector": [...], "dimension": [...],
"metrics": [...]}``. The session comes from ``SparkSession.builder`` (cluster
settings from spark-submit). A failing job exits non-zero.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):  # run as a file by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession  # noqa: E402

from wareflow.plans import jobs  # noqa: E402
from wareflow.session import configure  # noqa: E402


def _pairs(text: str) -> list[tuple]:
    return [tuple(p) for p in json.loads(text)]


def build_parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="wareflow", description=__doc__.split("\n\n")[0])
    ap.add_argument("--root", default=".", help="warehouse root (db.name -> root/db.db/name)")
    ap.add_argument("--format", default="parquet", help="stored table format, or 'delimited'")
    sub = ap.add_subparsers(dest="job", required=True)

    m = sub.add_parser("merge", help="upsert stg.<table> into ods.<table>")
    m.add_argument("table")
    m.add_argument("keys", help='[[":name", index], ...]')
    m.add_argument("--mode", default="join", choices=["join", "replace"])
    m.add_argument("--strict-single-file", action="store_true", help="fail unless the drop is one file")

    p = sub.add_parser("partition", help="stg.<table> -> partitioned ods.<table>")
    p.add_argument("table")
    p.add_argument("spec", nargs="?", default="[]", help='[[":name", index], ...]')
    p.add_argument("--files-per-partition", type=int, default=None)
    p.add_argument("--strict-single-file", action="store_true", help="fail unless the drop is one file")

    d = sub.add_parser("derive", help="typed, derived feature JSON")
    d.add_argument("source")
    d.add_argument("target")
    d.add_argument("columns", help="JSON list of column markers")
    d.add_argument("exprs", nargs="?", default="[]", help='[[":target", "body"], ...]')

    f = sub.add_parser("feature", help="feature config -> derive per data source")
    f.add_argument("config")

    r = sub.add_parser("role", help="role file + hand-off export for a config")
    r.add_argument("job_id")
    r.add_argument("config")
    r.add_argument("--data-root", required=True)
    r.add_argument("--conf-path", required=True)
    r.add_argument("--export-mode", default="overwrite", choices=["overwrite", "append"])

    k = sub.add_parser("kpi", help="KPI sheet -> keyed report table")
    k.add_argument("sheet")
    k.add_argument("target")
    k.add_argument("groups", help='{"group": ["member", ...], ...}')
    k.add_argument("specs", help="JSON list of report specs")
    return ap


def run(args: argparse.Namespace, spark: SparkSession) -> str:
    configure(spark)
    if args.job == "merge":
        return jobs.merge_job(spark, args.root, args.table, _pairs(args.keys),
                              mode=args.mode, fmt=args.format,
                              strict_single_file=args.strict_single_file)
    if args.job == "partition":
        return jobs.partition_job(spark, args.root, args.table, _pairs(args.spec) or None,
                                  fmt=args.format,
                                  files_per_partition=args.files_per_partition,
                                  strict_single_file=args.strict_single_file)
    if args.job == "derive":
        return jobs.derive_job(spark, args.root, args.source, args.target,
                               json.loads(args.columns), _pairs(args.exprs))
    if args.job == "feature":
        return ",".join(jobs.feature_job(spark, args.root, args.config))
    if args.job == "role":
        return jobs.role_job(spark, args.root, args.job_id, args.config, args.data_root,
                             args.conf_path, export_mode=args.export_mode)
    if args.job == "kpi":
        specs = [{part: _pairs(json.dumps(v)) for part, v in s.items()}
                 for s in json.loads(args.specs)]
        return jobs.kpi_job(spark, args.sheet, json.loads(args.groups), specs, args.target)
    raise ValueError(args.job)


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"wareflow-{args.job}").getOrCreate()
    print(run(args, spark))
    return 0


if __name__ == "__main__":
    sys.exit(main())
