"""Feature configs: JSON documents -> item catalog -> column specs, expressions, roles.

A feature config is one JSON document::

    {"classId" | "classified_id": "<id>",
     "data_sources": {"<source>": {"column_items": [...], "driven_items": [...],
                                   "target_items": [...]}}}

with items ``{"data_item": ..., "data_type": ..., "expr": ...}``. Any number
of documents are processed together: one row per document in, one row per
item out, every later step grouped by (class_id, source). A group is one
document's item list, so its size is bounded by the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (must equal the reference's for the same results):
# list names of a source entry, the types marked as strings in a column spec,
# the default item type, the role labels, the role-file row names and types,
# and the job-id pattern `<prefix>-<id>_<start>_<end>_<rest>`.
COLUMN_ITEMS, DRIVEN_ITEMS, TARGET_ITEMS = "column_items", "driven_items", "target_items"
STRING_TYPES = ["string", "date"]
DEFAULT_TYPE = "string"
TARGET_ROLE, INPUT_ROLE = "TargetCol", "InputCol"
PRED_START, PRED_END, DATE_TYPE = "PredStartDate", "PredEndDate", "Date"
INPUT_PATH, OUTPUT_PATH, PATH_TYPE = "InputDataPath", "OutDataPath", "string"
JOB_ID_PATTERN = r"[^-_]+-([^-_]+)_([^-_]+)_([^-_]+)_.*"

ITEM = T.StructType([T.StructField("data_item", T.StringType()),
                     T.StructField("data_type", T.StringType()),
                     T.StructField("expr", T.StringType())])
CONFIG_SCHEMA = T.StructType([
    T.StructField("classified_id", T.StringType()),
    T.StructField("classId", T.StringType()),
    T.StructField("data_sources", T.MapType(T.StringType(),
                                            T.MapType(T.StringType(), T.ArrayType(ITEM)))),
])

MODEL_LISTS = [DRIVEN_ITEMS, TARGET_ITEMS]


def _blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) == "", F.lit(None)).otherwise(c)


def feature_catalog(docs: DataFrame, json_col: str = "config",
                    prefer: str = "classified_id", keep: list[str] | None = None) -> DataFrame:
    """One row per item: class_id, source, list_name, list_pos, pos, data_item,
    data_type (as given, may be NULL), expr (NULL when absent or blank).

    ``prefer`` names the id field tried first (the other is the fallback).
    ``keep`` columns of ``docs`` are carried along.
    """
    other = "classId" if prefer == "classified_id" else "classified_id"
    keep = list(keep or [])
    parsed = docs.select(*keep, F.from_json(F.col(json_col), CONFIG_SCHEMA, {"mode": "FAILFAST"}).alias("c"))
    ids = parsed.select(
        *keep,
        F.coalesce(_blank_to_null(F.col(f"c.{prefer}")),
                   _blank_to_null(F.col(f"c.{other}"))).alias("class_id"),
        F.explode(F.col("c.data_sources")).alias("source", "lists"))
    lists = ids.select(*keep, "class_id", "source",
                       F.posexplode("lists").alias("list_pos", "list_name", "items"))
    items = lists.select(*keep, "class_id", "source", "list_name", "list_pos",
                         F.posexplode("items").alias("pos", "item"))
    return items.select(*keep, "class_id", "source", "list_name", "list_pos", "pos",
                        F.col("item.data_item").alias("data_item"),
                        F.col("item.data_type").alias("data_type"),
                        _blank_to_null(F.col("item.expr")).alias("expr"))


def _model_items(catalog: DataFrame) -> DataFrame:
    return (catalog.where(F.col("list_name").isin(MODEL_LISTS))
            .select("class_id", "source", "data_item").distinct())


def columns_for(catalog: DataFrame) -> DataFrame:
    """Column markers per (class_id, source), from ``column_items``.

    ``'`` marks string/date items; ``_`` hides items that no driven or target
    item names. Position 0 is always ``'prt_path``; items follow from 1.
    One grouping per item decides both; the per-config head rows come from
    the same grouping (its exchange is reused, the catalog is read once).
    """
    per_item = catalog.groupBy("class_id", "source", "data_item").agg(
        F.max(F.col("list_name").isin(MODEL_LISTS)).alias("_used"),
        F.collect_list(F.when(F.col("list_name") == COLUMN_ITEMS,
                              F.struct("pos", "data_type"))).alias("_cols"))
    cols = per_item.select("class_id", "source", "data_item", "_used",
                           F.explode("_cols").alias("c"))
    marker = F.concat(
        F.when(F.col("c.data_type").isin(STRING_TYPES), F.lit("'")).otherwise(F.lit("")),
        F.when(F.col("_used"), F.lit("")).otherwise(F.lit("_")),
        F.col("data_item"))
    items = cols.select("class_id", "source", (F.col("c.pos") + 1).alias("pos"),
                        marker.alias("column_marker"))
    heads = (per_item.select("class_id", "source").distinct()
             .select("class_id", "source", F.lit(0).alias("pos"),
                     F.lit("'prt_path").alias("column_marker")))
    return heads.unionByName(items)


def exprs_for(catalog: DataFrame) -> DataFrame:
    """Expressions per (class_id, source): items with an expr, in list order."""
    return (catalog.where(F.col("expr").isNotNull())
            .select("class_id", "source", "list_pos", "pos",
                    F.concat(F.lit(":"), F.col("data_item")).alias("target"),
                    F.col("expr").alias("body")))


def _typed(catalog: DataFrame) -> DataFrame:
    return catalog.withColumn(
        "data_type", F.coalesce(_blank_to_null(F.col("data_type")), F.lit(DEFAULT_TYPE)))


def feature_roles(catalog: DataFrame) -> DataFrame:
    """(class_id, source, role, data_item, data_type, item_order).

    Declared items (column items, plus driven/target items with an expr) that
    also appear as a driven or target (item, type) pair; a missing type counts
    as ``string``. Role is TargetCol when the item is a target, else InputCol.
    ``item_order`` is the first position of the pair among the declared items:
    column items, then driven, then target items, however the JSON orders its lists.

    One grouping per (config, item): the entries of one item within one
    document are few, so they are decided together in that row.
    """
    typed = _typed(catalog)
    is_model = F.col("list_name").isin(MODEL_LISTS)
    declared = (F.col("list_name") == COLUMN_ITEMS) | (is_model & F.col("expr").isNotNull())
    order = F.struct(F.when(F.col("list_name") == COLUMN_ITEMS, 0).otherwise(1).alias("a"),
                     (F.col("list_name") == TARGET_ITEMS).cast("int").alias("b"), F.col("pos").alias("c"))
    entry = F.struct(F.col("data_type").alias("t"), declared.alias("d"),
                     is_model.alias("m"), order.alias("o"))
    per_item = typed.groupBy("class_id", "source", "data_item").agg(
        F.max(F.col("list_name") == TARGET_ITEMS).alias("_target"),
        F.collect_list(entry).alias("_e"))
    by_type = per_item.select(
        "class_id", "source", "data_item", "_target", "_e",
        F.explode(F.array_distinct(F.transform("_e", lambda e: e["t"]))).alias("data_type"))
    mine = F.filter("_e", lambda e: e["t"] == F.col("data_type"))
    first = F.array_min(F.transform(F.filter(mine, lambda e: e["d"]), lambda e: e["o"]))
    used = F.exists(mine, lambda e: e["m"])
    role = F.when(F.col("_target"), F.lit(TARGET_ROLE)).otherwise(F.lit(INPUT_ROLE))
    return (by_type.select("class_id", "source", role.alias("role"), "data_item", "data_type",
                           first.alias("item_order"), used.alias("_used"))
            .where(F.col("item_order").isNotNull() & F.col("_used")).drop("_used"))


def parse_job_id(job_id: Column) -> Column:
    """``<prefix>-<id>_<start>_<end>_<rest>`` -> struct(class_id, start, end).

    The pattern is searched, not anchored: in ``data_wh-c1_...`` the
    prefix match starts at ``store``.
    """
    return F.struct(
        F.regexp_extract(job_id, JOB_ID_PATTERN, 1).alias("class_id"),
        F.regexp_extract(job_id, JOB_ID_PATTERN, 2).alias("start"),
        F.regexp_extract(job_id, JOB_ID_PATTERN, 3).alias("end"))


def data_path(data_root: str, class_id: str, source: str) -> str:
    """The exported feature data of one source: a folder of part files under that name."""
    return f"{data_root.rstrip('/')}/in/{class_id}/{source}/data.csv"


def role_rows(roles: DataFrame, jobs: DataFrame, data_root: str) -> DataFrame:
    """Lines of each (class_id, source) role file: (class_id, source, line_no, line).

    Role lines ``role,item,type`` in declared order, then the prediction window
    from the job id and the input/output data paths. ``jobs`` has
    (class_id, source, job_id); every listed pair gets its four trailing lines.
    Both kinds of line are numbered by one window per config.
    """
    body = roles.select(
        "class_id", "source", F.struct(F.lit(0).alias("k"), F.col("item_order").alias("o"))
        .alias("_key"), F.concat_ws(",", "role", "data_item", "data_type").alias("line"))
    j = parse_job_id(F.col("job_id"))
    root = data_root.rstrip("/")
    tail = F.array(
        F.concat_ws(",", F.lit(PRED_START), j["start"], F.lit(DATE_TYPE)),
        F.concat_ws(",", F.lit(PRED_END), j["end"], F.lit(DATE_TYPE)),
        F.concat_ws(",", F.lit(INPUT_PATH),
                    F.format_string(data_path("%s", "%s", "%s"), F.lit(root), "class_id", "source"),
                    F.lit(PATH_TYPE)),
        F.concat_ws(",", F.lit(OUTPUT_PATH),
                    F.concat(F.lit(f"{root}/out/"), F.col("class_id"), F.lit("/data.csv")),
                    F.lit(PATH_TYPE)))
    tails = jobs.select("class_id", "source", F.posexplode(tail).alias("_k", "line")).select(
        "class_id", "source",
        F.struct(F.lit(1).alias("k"),
                 F.struct(F.lit(0).alias("a"), F.lit(0).alias("b"), F.col("_k").alias("c"))
                 .alias("o")).alias("_key"),
        "line")
    w = Window.partitionBy("class_id", "source").orderBy("_key")
    return (body.unionByName(tails)
            .select("class_id", "source", F.row_number().over(w).alias("line_no"), "line"))


def write_role_files(rows: DataFrame, path: str) -> str:
    """One text file per (class_id, source) folder, lines in order.

    Rows of one config go to one task (a config is one document, so the group
    is small) and are sorted there; the writer keeps that order.
    """
    (rows.repartition("class_id", "source")
         .sortWithinPartitions("class_id", "source", "line_no")
         .select("line", "class_id", "source")
         .write.mode("overwrite").partitionBy("class_id", "source").text(path))
    return path


def spec_lists(catalog: DataFrame, class_id: str, source: str) -> tuple[list[str], list[tuple[str, str]]]:
    """Driver-side (column markers, expressions) of ONE config, for launching a job.

    Collects only that config's items (bounded by the document), both lists
    in one action.
    """
    one = catalog.where((F.col("class_id") == class_id) & (F.col("source") == source))
    cols = columns_for(one).select(F.lit(0).alias("kind"), F.col("pos").alias("a"),
                                   F.lit(0).alias("b"), F.col("column_marker").alias("t1"),
                                   F.lit(None).cast("string").alias("t2"))
    exprs = exprs_for(one).select(F.lit(1).alias("kind"), F.col("list_pos").alias("a"),
                                  F.col("pos").alias("b"), F.col("target").alias("t1"),
                                  F.col("body").alias("t2"))
    got = sorted((r["kind"], r["a"], r["b"], r["t1"], r["t2"])
                 for r in cols.unionByName(exprs).collect())
    markers = [t1 for kind, _, _, t1, _ in got if kind == 0]
    expressions = [(t1, t2) for kind, _, _, t1, t2 in got if kind == 1]
    return markers, expressions
