"""Composite jobs: the user-level entry points.

Tables live under a warehouse ``root`` and are addressed ``db.name[.part]``
(``stg.orders`` -> ``<root>/stg.db/orders``). Every job is a chain of lazy
DataFrame operators ending in one committed write; nothing passes through the
driver but specs, names and counts.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wareflow.functions.spec import parse_columns, resolve, split_pairs
from wareflow.operators.derive import bind_types, derive, drop_hidden
from wareflow.operators.features import (JOB_ID_PATTERN, data_path, feature_catalog, feature_roles,
                                         role_rows, spec_lists, write_role_files)
from wareflow.operators.kpi import ID_COLUMNS, explode_long, period_deltas, read_kpi_sheet_long
from wareflow.operators.partition import PRT_PATH, level_names, with_levels, with_prt_path
from wareflow.operators.report import report_table
from wareflow.operators.upsert import replace_into, upsert
from wareflow.session import configure
from wareflow.sinks.catalog import ensure_external_table, repair
from wareflow.sinks.files import (delimited_line, export_parts, path_exists, publish_partitions,
                                  publish_table, recover_table, write_delimited, write_feature_json)
from wareflow.sinks.layouts import finish_layouts, stored_layouts, write_layouts
from wareflow.sources.text import read_delimited, read_lines, read_staging


def _key_names(stg: DataFrame, keys) -> list[str]:
    """Key names from names or ``[[":name", index], ...]`` pairs (index wins)."""
    if keys and not isinstance(keys[0], str):
        names, idx = split_pairs(keys)
        return [stg.columns[i] for i in idx]
    return [k.lstrip(":") for k in keys]


def _stored_or_empty(spark: SparkSession, path: str, like: DataFrame, fmt: str) -> DataFrame:
    """The stored table at ``path`` (``like``'s columns when delimited), or none.

    A swap that a dead driver left half done is finished first: the table that
    is read must be the one that the publish will replace.
    """
    recover_table(spark, path)
    if path_exists(spark, path):
        if fmt == "delimited":
            return read_delimited(spark, path, like.columns)
        return spark.read.format(fmt).load(path)
    return spark.createDataFrame([], like.schema)


def _publish_whole(df: DataFrame, path: str, fmt: str) -> None:
    if fmt == "delimited":
        publish_table(df.select(delimited_line(df).alias("value")), path, fmt="text")
    else:
        publish_table(df, path, fmt=fmt)


def merge_job(spark: SparkSession, root: str, table: str, keys, mode: str = "join",
              fmt: str = "parquet", catalog_name: str | None = None,
              new_columns: str = "fail", strict_single_file: bool = False) -> str:
    """Upsert ``stg.<table>`` (header-checked CSV) into ``ods.<table>``.

    The stored table is both input and output, so it is published by swap.
    ``fmt`` is a Spark file format, or ``"delimited"`` for headerless
    ``\x01`` text with the staging header's columns. ``new_columns="add"`` lets
    staging bring columns that a stored file-format table lacks.
    ``strict_single_file`` fails unless the drop is one file.
    """
    configure(spark)
    stg = read_staging(spark, resolve(root, f"stg.{table}"), strict_single_file=strict_single_file)
    ods_path = resolve(root, f"ods.{table}")
    ods = _stored_or_empty(spark, ods_path, stg, fmt)
    merged = upsert(stg, ods, _key_names(stg, keys), mode=mode, new_columns=new_columns)
    _publish_whole(merged, ods_path, fmt)
    ensure_external_table(spark, catalog_name or f"ods.{table}", merged.columns, [], ods_path, fmt)
    return ods_path


def partition_job(spark: SparkSession, root: str, table: str, prt_spec=None,
                  fmt: str = "parquet", catalog_name: str | None = None,
                  files_per_partition: int | None = None, strict_single_file: bool = False) -> str:
    """Staging CSV -> ``prt_path`` first -> partitions replaced -> table repaired.

    ``prt_spec`` is ``[[":name", index], ...]`` (the partition value is the
    staging field at ``index``); empty or None writes the table unpartitioned.
    ``files_per_partition`` bounds the files per directory (see
    :func:`wareflow.sinks.files.write_partitioned`). ``strict_single_file``
    fails unless the drop is one file.
    """
    configure(spark)
    stg = read_staging(spark, resolve(root, f"stg.{table}"), strict_single_file=strict_single_file)
    ods_path = resolve(root, f"ods.{table}")
    names, idx = split_pairs(prt_spec or [])
    spec = [(n, F.col(f"`{stg.columns[i]}`")) for n, i in zip(names, idx)]
    rows = with_prt_path(stg, spec)
    name = catalog_name or f"ods.{table}"
    if names:
        routed = with_levels(stg, spec)
        if fmt == "delimited":
            write_delimited(routed, ods_path, parts=names)
        else:
            publish_partitions(routed, ods_path, names, fmt=fmt,
                               files_per_partition=files_per_partition)
        data = [c for c in routed.columns if c not in names]
        ensure_external_table(spark, name, data, names, ods_path, fmt)
        repair(spark, name)
    else:
        _publish_whole(rows, ods_path, fmt)
        ensure_external_table(spark, name, rows.columns, [], ods_path, fmt)
    return ods_path


def derive_job(spark: SparkSession, root: str, source: str, target: str,
               columns: Sequence[str], exprs: Sequence = (), sep: str = "\x01",
               on_bad_number: str = "fail", files_per_partition: int | None = None) -> str:
    """``\\x01`` rows of ``source`` -> typed, derived, hidden dropped ->
    JSON lines in ``target``, replacing only the partitions produced.

    A declared first column ``prt_path``, hidden or not, routes each row by the
    levels its own path names; rows with a blank path take the default
    partition of the longest list of levels. Rows may name different lists of
    levels, within a run or over runs (see :mod:`wareflow.sinks.layouts`;
    ``read_feature_table`` reads such a table). When every path is blank the
    table is written whole, unless the stored one has partitions: that fails.
    An empty source, with or without ``prt_path``, replaces nothing.
    """
    configure(spark)
    finish_layouts(spark, resolve(root, target))
    specs = parse_columns(list(columns))
    rows = read_delimited(spark, resolve(root, source), [s.name for s in specs], sep)
    path = resolve(root, target)
    derived = derive(bind_types(rows, specs, on_bad_number=on_bad_number), exprs)
    if not specs or specs[0].name != PRT_PATH:
        if rows.isEmpty():
            return path
        write_feature_json(drop_hidden(derived, specs), path, [],
                           files_per_partition=files_per_partition)
        return path
    shown = drop_hidden(derived, [s for s in specs if s.name != PRT_PATH])
    layouts = level_names(shown)
    stored = [names for _, names in stored_layouts(spark, path)]
    if layouts == [[]]:
        if stored:
            raise ValueError(f"{target} has partitions, but no row's {PRT_PATH} names a level")
        write_feature_json(drop_hidden(derived, specs), path, [],
                           files_per_partition=files_per_partition)
        return path
    named = [layout for layout in layouts if layout]
    if len(named) == 1 and stored in ([], named):
        write_feature_json(shown, path, named[0], hidden=specs[0].hidden,
                           files_per_partition=files_per_partition)
    elif named:
        write_layouts(shown, path, named, hidden=specs[0].hidden, files_per_partition=files_per_partition)
    return path


def feature_job(spark: SparkSession, root: str, config_json: str,
                model_db: str = "model", out_db: str = "4ml") -> list[str]:
    """C4: one feature config -> for each data source, ``derive_job`` from
    ``model.<source>`` to ``4ml.<id>.<source>``; stops at the first failure."""
    configure(spark)
    docs = spark.createDataFrame([(config_json,)], "config string")
    cat = feature_catalog(docs, prefer="classified_id")
    pairs = [(r["class_id"], r["source"]) for r in
             cat.select("class_id", "source").distinct().orderBy("source").collect()]
    out = []
    for class_id, source in pairs:
        cols, exprs = spec_lists(cat, class_id, source)
        out.append(derive_job(spark, root, f"{model_db}.{source}",
                              f"{out_db}.{class_id}.{source}", cols, exprs))
    return out


def role_job(spark: SparkSession, root: str, job_id: str, config_json: str,
             data_root: str, conf_path: str, out_db: str = "4ml",
             export_mode: str = "overwrite") -> str:
    """Role file (one per config source) plus the hand-off export of the
    derived feature data of every source (a folder of part files each)."""
    configure(spark)
    m = re.search(JOB_ID_PATTERN, job_id)
    if not m:
        raise ValueError(f"job id {job_id!r} does not match {JOB_ID_PATTERN}")
    docs = spark.createDataFrame([(config_json,)], "config string")
    cat = feature_catalog(docs, prefer="classId")
    sources = cat.select("class_id", "source").distinct()
    jobs = sources.select("class_id", "source", F.lit(job_id).alias("job_id"))
    write_role_files(role_rows(feature_roles(cat), jobs, data_root), conf_path)
    for r in sources.collect():
        data = read_lines(spark, resolve(root, f"{out_db}.{r['class_id']}.{r['source']}"))
        export_parts(data.select("value"), data_path(data_root, r["class_id"], r["source"]),
                     mode=export_mode)
    return conf_path


def kpi_job(spark: SparkSession, sheet_path: str, groups, specs: Sequence[dict],
            target_path: str, category: str = "score") -> str:
    """KPI sheet -> long rows with deltas and groups -> report trees ->
    keyed REPLACE on (name, category, selector) into the stored report table."""
    configure(spark)
    # The sheet's rows are used for the uniqueness check, the documents' sizes and
    # the documents, which in turn are used for the key count in replace_into and
    # the write: both are kept for the job's duration. Lost blocks are recomputed.
    long = read_kpi_sheet_long(spark, sheet_path).persist(StorageLevel.MEMORY_AND_DISK)
    fresh = None
    try:
        rows = explode_long(period_deltas(long, ID_COLUMNS, check_unique=True), groups)
        fresh = report_table(rows, specs, category).persist(StorageLevel.MEMORY_AND_DISK)
        stored = _stored_or_empty(spark, target_path, fresh, "parquet")
        merged = replace_into(stored, fresh, ["name", "category", "selector"])
        publish_table(merged, target_path)
    finally:
        for held in (long, fresh):
            if held is not None:
                held.unpersist()
    return target_path
