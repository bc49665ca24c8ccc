"""wareflow: warehouse ETL, feature and KPI-report operators on Spark DataFrames.

Public API (all take and return DataFrames unless noted)::

    from wareflow import upsert, replace_into, apply_spec, merge_job, ...
"""

from wareflow.functions.columns import bind_fields, comparison_names, month_name, parse_month, tree_key
from wareflow.functions.spec import fill_header, parse_columns, resolve, to_spark_sql
from wareflow.operators.derive import apply_spec, bind_types, derive, drop_hidden
from wareflow.operators.edges import invert, links, roots, tagged, with_defaults
from wareflow.operators.features import (columns_for, exprs_for, feature_catalog,
                                         feature_roles, parse_job_id, role_rows,
                                         write_role_files)
from wareflow.operators.kpi import (map_groups, period_deltas, read_kpi_sheet,
                                    read_kpi_sheet_long, unpivot_kpi)
from wareflow.operators.partition import parse_prt_path, with_prt_path
from wareflow.operators.report import match_constants, report, report_table, report_tree
from wareflow.operators.upsert import replace_into, upsert
from wareflow.plans.jobs import (derive_job, feature_job, kpi_job, merge_job, partition_job,
                                 role_job)
from wareflow.session import build_session, checkpoint_root, configure, scratch_path
from wareflow.sinks.catalog import ensure_external_table, repair
from wareflow.sinks.files import (export_parts, publish_partitions, publish_table,
                                  recover_table, write_delimited, write_feature_json,
                                  write_partitioned, write_staging_csv)
from wareflow.sinks.layouts import read_feature_table
from wareflow.sources.text import (check_headers, first_lines, read_bound, read_delimited,
                                   read_feature_json, read_lines, read_staging, skip_rows, tag_rows)
from wareflow.streaming.ingest import ingest_merge, ingest_partitions, merge_batch

__version__ = "0.1.0"

__all__ = [
    "apply_spec", "bind_fields", "bind_types", "build_session", "check_headers", "checkpoint_root",
    "columns_for", "comparison_names", "configure", "derive", "derive_job", "drop_hidden",
    "ensure_external_table", "export_parts", "exprs_for", "feature_catalog", "feature_job",
    "feature_roles", "fill_header", "first_lines", "ingest_merge", "ingest_partitions", "merge_batch", "invert", "kpi_job", "links",
    "map_groups", "match_constants", "merge_job", "month_name", "parse_columns", "parse_job_id",
    "parse_month", "parse_prt_path", "partition_job", "period_deltas", "publish_partitions",
    "publish_table", "read_bound", "read_delimited", "read_feature_json", "read_feature_table", "read_kpi_sheet",
    "read_kpi_sheet_long", "read_lines", "read_staging", "recover_table", "repair",
    "replace_into", "report", "report_table", "report_tree", "resolve", "role_job",
    "role_rows", "roots", "scratch_path", "skip_rows", "tag_rows", "tagged", "to_spark_sql", "tree_key",
    "unpivot_kpi", "upsert", "with_defaults", "with_prt_path", "write_delimited",
    "write_feature_json", "write_partitioned", "write_role_files", "write_staging_csv",
]
