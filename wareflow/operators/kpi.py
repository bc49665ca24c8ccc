"""KPI sheets: wide ``<kpi>_<MMMyy>`` columns -> long rows -> period deltas -> groups.

Long row fields: date (``yyyy-MM``), group, bottler, channel, kpi, score,
score_pp (vs previous month), score_ly (vs last December), score_tb (vs the
same month last year). A missing comparison value counts as 0, so the delta
is then the score itself.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareflow.functions.columns import month_index, parse_month
from wareflow.operators.keys import per_key
from wareflow.operators.measure import fits_broadcast
from wareflow.sources.text import first_lines, read_data_lines, split_fields

# Fixed values (must equal the reference's): the two id columns of a sheet,
# the header cell that ends the KPI columns, the number of leading rows before data.
ID_COLUMNS = ["bottler_cn", "bottler_en"]
SENTINEL = "_"
SKIP_ROWS = 3

LONG_FIELDS = ["date", "group", "bottler", "channel", "kpi",
               "score", "score_pp", "score_ly", "score_tb"]


# ---------------------------------------------------------------- sheet ----

def sheet_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a sheet: the id columns, then header cells up to ``_``.

    Reads only the first line of each file; all files must agree.
    """
    heads = first_lines(spark, path).select("line").distinct().limit(2).collect()
    if len(heads) != 1:
        raise ValueError("sheet headers differ across files" if heads else f"no sheet lines below {path}")
    cells = heads[0]["line"].split(",")
    names = []
    for cell in cells[len(ID_COLUMNS):]:
        if cell.strip() == SENTINEL:
            break
        names.append(cell.strip())
    return ID_COLUMNS + names


def read_kpi_sheet(spark: SparkSession, path: str, skip: int = SKIP_ROWS) -> DataFrame:
    """Wide sheet rows (CSV, no quoting): id columns + KPI columns as text.

    The first ``skip`` lines of every file (header and notes) are dropped;
    columns after the ``_`` header cell are ignored; empty cells are NULL.
    """
    names = sheet_header(spark, path)
    data = read_data_lines(spark, path, skip).where(F.col("value") != "")
    fields = split_fields(F.col("value"), names, sep=",")
    return data.select(*[F.nullif(f, F.lit("")).alias(n) for f, n in zip(fields, names)])


def read_kpi_sheet_long(spark: SparkSession, path: str, skip: int = SKIP_ROWS) -> DataFrame:
    """The sheet straight to long rows (ids..., kpi, month DATE, value DOUBLE).

    Same rows as ``unpivot_kpi(read_kpi_sheet(...))`` without building the
    wide frame: each line is split once and its KPI cells exploded with their
    position, which names the column. Empty cells are dropped.
    """
    names = sheet_header(spark, path)
    kpis = names[len(ID_COLUMNS):]
    data = read_data_lines(spark, path, skip).where(F.col("value") != "")
    parts = F.split(F.col("value"), ",", -1)
    ids = [F.get(parts, i).alias(n) for i, n in enumerate(ID_COLUMNS)]
    cells = F.slice(parts, len(ID_COLUMNS) + 1, len(kpis))
    exploded = data.select(*ids, F.posexplode(cells).alias("_i", "_cell"))
    column = F.element_at(F.array(*[F.lit(k) for k in kpis]), F.col("_i") + 1)
    kept = exploded.where(F.col("_cell").isNotNull() & (F.col("_cell") != ""))
    name_parts = F.split(column, "_", 2)
    return kept.select(*ID_COLUMNS, F.get(name_parts, 0).alias("kpi"),
                       parse_month(F.get(name_parts, 1)).alias("month"),
                       F.col("_cell").cast("double").alias("value"))


# ------------------------------------------------------------- reshape ----

def unpivot_kpi(wide: DataFrame, ids: Sequence[str] = tuple(ID_COLUMNS)) -> DataFrame:
    """Wide -> long (ids..., kpi, month DATE, value DOUBLE); missing cells dropped."""
    ids = list(ids)
    cols = [c for c in wide.columns if c not in ids]
    if len({t for c, t in wide.dtypes if c in cols}) > 1:
        # unpivot needs one value type; cast only when the sheet mixes types
        wide = wide.select(*ids, *[F.col(f"`{c}`").cast("double").alias(c) for c in cols])
    long = wide.unpivot(ids, cols, "kpi_month", "value").where(F.col("value").isNotNull())
    parts = F.split(F.col("kpi_month"), "_", 2)
    return long.select(*ids, F.get(parts, 0).alias("kpi"),
                       parse_month(F.get(parts, 1)).alias("month"),
                       F.col("value").cast("double").alias("value"))


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail when two rows share ``keys`` (one aggregation); returns ``df``."""
    dup = (df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
           .where(F.col("_n") > 1).first())
    if dup is not None:
        raise ValueError(f"rows are not unique on {list(keys)}: {dup.asDict()}")
    return df


def period_deltas(long: DataFrame, entity: Sequence[str], kpi: str = "kpi",
                  month: str = "month", value: str = "value",
                  check_unique: bool = False) -> DataFrame:
    """Add score_pp, score_ly, score_tb (value minus the comparison value, or
    the value itself when that period is missing).

    One window per (entity, kpi) ordered by month index: a one-month and a
    twelve-month range frame (gaps respected, unlike ``lag``), and the last
    December seen before the row, kept only when it is last year's. Rows must
    be unique per (entity, kpi, month), so a window holds at most one row per
    calendar month; ``check_unique=True`` verifies that first (a sheet row is
    one entity, and two rows with the same ids must not be merged).
    """
    if check_unique:
        require_unique(long, [*entity, kpi, month])
    m = month_index(F.col(month))
    w = Window.partitionBy(*[F.col(c) for c in entity], F.col(kpi)).orderBy(m)
    v = F.col(value)
    prev = F.max(v).over(w.rangeBetween(-1, -1))
    year_ago = F.max(v).over(w.rangeBetween(-12, -12))
    dec = F.when(F.month(month) == 12, F.struct(m.alias("m"), v.alias("v")))
    last_dec = F.last(dec, ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, -1))
    ly = F.when(last_dec["m"] == F.year(month) * 12 - 1, last_dec["v"])
    return long.select(
        "*",
        (v - F.coalesce(prev, F.lit(0.0))).alias("score_pp"),
        (v - F.coalesce(ly, F.lit(0.0))).alias("score_ly"),
        (v - F.coalesce(year_ago, F.lit(0.0))).alias("score_tb"))


def group_table(spark: SparkSession, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """(member, group) from a group -> members mapping; the last group listing
    a member wins."""
    owner: dict[str, str] = {}
    for g, members in groups.items():
        for m in members:
            owner[m] = g
    schema = T.StructType([T.StructField("member", T.StringType()),
                           T.StructField("group", T.StringType())])
    return spark.createDataFrame(sorted(owner.items()), schema)


MAX_BROADCAST_GROUP_ROWS = 1_000_000
MAX_BROADCAST_GROUP_BYTES = 256 * 1024 * 1024


def map_groups(df: DataFrame, groups, member_col: str, group_col: str = "group") -> DataFrame:
    """Left join member -> group; unmapped members keep a NULL group.

    ``groups`` is a dict or a (member, group[, seq]) DataFrame (deduplicated
    per member: highest seq wins, else the greatest group). Either way the
    mapping is broadcast only when it is measured to be within
    :data:`MAX_BROADCAST_GROUP_ROWS` and :data:`MAX_BROADCAST_GROUP_BYTES`;
    otherwise it is an ordinary shuffled join.
    """
    if isinstance(groups, Mapping):
        mapping = group_table(df.sparkSession, groups)
    else:
        order = F.struct("seq", "group") if "seq" in groups.columns else F.struct("group")
        mapping = (per_key(groups, ["member"], F.max(order).alias("_o"))
                   .select("member", F.col("_o.group").alias("group")))
    if fits_broadcast(mapping, MAX_BROADCAST_GROUP_ROWS, MAX_BROADCAST_GROUP_BYTES):
        mapping = F.broadcast(mapping)
    mapping = mapping.withColumnRenamed("group", group_col)
    return df.join(mapping, df[member_col] == mapping["member"], "left").drop(mapping["member"])


def explode_long(deltas: DataFrame, groups, entity_col: str = "bottler_en") -> DataFrame:
    """Deltas -> the nine long fields; bottler and channel split from ``entity_col``."""
    parts = F.split(F.col(entity_col), "_", 2)
    rows = deltas.select(
        F.date_format("month", "yyyy-MM").alias("date"),
        F.get(parts, 0).alias("bottler"), F.get(parts, 1).alias("channel"),
        "kpi", F.col("value").alias("score"), "score_pp", "score_ly", "score_tb")
    grouped = map_groups(rows, groups, "bottler")
    return grouped.select(*LONG_FIELDS)
