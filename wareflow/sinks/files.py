"""File sinks: partitioned tables, feature JSON, ``\\x01`` text, publishing.

All writes go through Spark's file committer: a task's output becomes visible
only when the job commits, so a lost executor just reruns its task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wareflow.operators.partition import PRT_PATH, parse_prt_path

CTRL_A = "\x01"


def _spread(df: DataFrame, parts: list[str], files_per_partition: int | None) -> DataFrame:
    """Optionally bound files per output directory without funnelling a hot one.

    Rows are hashed on the partition columns plus a deterministic salt (a hash
    of the whole row, so a retried task sees the same split), giving each
    partition value up to ``files_per_partition`` writer tasks. Without it the
    writer just sorts each task's rows by the partition columns (no shuffle).
    """
    if not files_per_partition:
        return df
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]),
                  F.lit(files_per_partition))
    return df.repartition(*[F.col(f"`{p}`") for p in parts], salt)


def write_partitioned(df: DataFrame, path: str, parts: list[str] | None = None,
                      fmt: str = "parquet", mode: str = "overwrite",
                      dynamic: bool = True, files_per_partition: int | None = None,
                      **options) -> str:
    """Multi-level ``name=value`` directories, one file per (partition, task).

    With ``dynamic=True`` an overwrite replaces only the leaf directories this
    write produces; every other partition stays as it was.
    """
    parts = list(parts or [])
    writer = _spread(df, parts, files_per_partition).write.mode(mode).format(fmt)
    if parts:
        writer = writer.partitionBy(*parts)
        if dynamic and mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "dynamic")
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.save(path)
    return path


def publish_partitions(df: DataFrame, path: str, parts: list[str], fmt: str = "parquet",
                       files_per_partition: int | None = None, **options) -> str:
    """Replace exactly the partitions present in ``df`` (dynamic overwrite)."""
    return write_partitioned(df, path, parts, fmt=fmt, mode="overwrite", dynamic=True,
                             files_per_partition=files_per_partition, **options)


def write_feature_json(df: DataFrame, path: str, prt_names: list[str] | None,
                       mode: str = "overwrite", files_per_partition: int | None = None,
                       hidden: bool = False) -> str:
    """JSON lines routed by ``prt_path``; ``prt_path`` stays inside each record unless ``hidden``.

    ``prt_names`` are the directory levels spelled in ``prt_path``. With no
    ``prt_path`` column (or no names) the table is written unpartitioned.
    NULL fields are omitted from the JSON records.
    """
    if prt_names and PRT_PATH in df.columns:
        routed = parse_prt_path(df, prt_names)
        if hidden:
            routed = routed.drop(PRT_PATH)
        return write_partitioned(routed, path, prt_names, fmt="json", mode=mode,
                                 files_per_partition=files_per_partition,
                                 ignoreNullFields="true")
    df.write.mode(mode).option("ignoreNullFields", "true").json(path)
    return path


def delimited_line(df: DataFrame, sep: str = CTRL_A) -> Column:
    """All columns as text joined by ``sep``; NULL becomes empty (keeps arity)."""
    return F.concat_ws(sep, *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
                              for c in df.columns])


def write_delimited(df: DataFrame, path: str, sep: str = CTRL_A,
                    parts: list[str] | None = None, mode: str = "overwrite") -> str:
    """Headerless delimited text, one line per row (partition columns as dirs)."""
    parts = list(parts or [])
    data = df.drop(*parts) if parts else df
    lines = df.select(delimited_line(data, sep).alias("value"),
                      *[F.col(f"`{p}`") for p in parts])
    writer = lines.write.mode(mode)
    if parts:
        writer = writer.partitionBy(*parts).option("partitionOverwriteMode", "dynamic")
    writer.text(path)
    return path


def write_staging_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Comma separated, header line in every file, no quoting.

    The format cannot hold a comma or a line break inside a value: such a value fails the write.
    """
    (_plain(df, ",").write.mode(mode).options(**_UNALTERED).option("header", "true")
     .option("escapeQuotes", "false").csv(path))
    return path


#: CSV options under which values are written as they are.
_UNALTERED = {"quote": "", "emptyValue": "", "ignoreLeadingWhiteSpace": "false",
              "ignoreTrailingWhiteSpace": "false"}


def _plain(df: DataFrame, sep: str) -> DataFrame:
    """``df`` as text; a value that holds ``sep`` or a line break fails."""
    def checked(c: str) -> Column:
        text = F.col(f"`{c}`").cast("string")
        bad = text.contains(sep) | text.contains("\n") | text.contains("\r")
        return F.when(bad, F.raise_error(F.concat(
            F.lit(f"column {c!r}: separator or line break in value: "), text))).otherwise(text).alias(c)

    return df.select(*[checked(c) for c in df.columns])


def export_parts(df: DataFrame, path: str, mode: str = "overwrite",
                 sep: str = ",", header: bool = False) -> str:
    """Hand-off export as one directory of part files.

    The hand-off reader globs the parts (as a ``*/*`` concatenation would);
    the rows are never funnelled through a single task. ``mode="append"``
    adds new parts next to old ones (reruns then duplicate rows). Values are
    written as they are; one that holds ``sep`` or a line break fails. A single
    column without a header is written as text lines.
    """
    if len(df.columns) == 1 and not header:
        df.select(F.coalesce(F.col(f"`{df.columns[0]}`").cast("string"), F.lit("")).alias("value")
                  ).write.mode(mode).text(path)
        return path
    (_plain(df, sep).write.mode(mode).options(**_UNALTERED)
     .option("header", str(header).lower()).option("sep", sep).csv(path))
    return path


# --------------------------------------------------------------------------
# Whole-table publish for a table that is also an input of the same job.
# --------------------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return bool(fs.exists(jpath))


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder; ``to`` must not exist."""
    fs, source = _fs(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    if fs.exists(target) or not fs.rename(source, target):
        raise IOError(f"could not move {path} to {to}")


def retire_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in two steps, so that a crash never leaves part of it under its name."""
    gone = f"{path}__retired_{uuid.uuid4().hex[:12]}"
    move_folder(spark, path, gone)
    fs, jpath = _fs(spark, gone)
    fs.delete(jpath, True)


def add_files(spark: SparkSession, staged: str, path: str, depth: int) -> None:
    """Move the files of a staged partitioned folder (``depth`` levels) beside those that ``path`` holds,
    then delete the folder.

    Spark names every file of a write uniquely, so nothing is replaced; a call that died half-way is
    finished by another one, which finds only the files that are left.
    """
    fs, at = _fs(spark, staged + "/*=*" * depth + "/*")
    as_path = spark._jvm.org.apache.hadoop.fs.Path
    for st in fs.globStatus(at) or []:
        name = st.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        below = "/".join(st.getPath().toString().split("/")[-1 - depth:-1])
        folder = as_path(f"{path}/{below}")
        fs.mkdirs(folder)
        if not fs.rename(st.getPath(), as_path(folder, name)):
            raise IOError(f"could not move {st.getPath().toString()} to {path}")
    fs.delete(as_path(staged), True)


def recover_table(spark: SparkSession, path: str) -> None:
    """Finish a swap a dead driver left half done.

    If ``path`` is missing but a retired copy exists, the crash came between
    the two renames: the newest retired copy is moved back. If ``path``
    exists, retired copies are leftovers of a finished swap and are deleted.
    """
    fs, target = _fs(spark, path)
    jvm = spark._jvm
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}__retired_*"))
    retired = sorted((st for st in (found or [])), key=lambda st: st.getModificationTime())
    if not retired:
        return
    if not fs.exists(target):
        fs.rename(retired[-1].getPath(), target)
        retired = retired[:-1]
    for st in retired:
        fs.delete(st.getPath(), True)


MARKER_PREFIX = "_wareflow_batch_"


def applied_batch(spark: SparkSession, path: str, stream_id: str = "") -> int:
    """Highest batch id recorded in the table at ``path`` (-1 when none).

    Batch ids count within one stream; a table that another stream filled fails.
    """
    fs, _ = _fs(spark, path)
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MARKER_PREFIX}*"))
    ids = []
    for st in found or []:
        number, _, stream = st.getPath().getName()[len(MARKER_PREFIX):].partition("_")
        if stream != stream_id:
            raise ValueError(f"{path} was filled by stream {stream!r}, not {stream_id!r}: its checkpoint "
                             "was replaced, so which drops it holds is unknown")
        ids.append(int(number))
    return max(ids, default=-1)


def publish_table(df: DataFrame, path: str, fmt: str = "parquet",
                  batch_id: int | None = None, stream_id: str = "", **options) -> str:
    """Write ``df`` beside ``path`` and swap it in.

    ``df`` may read ``path`` itself: Spark refuses (or empties the table on)
    a direct self-overwrite, so the new data is committed to a sibling
    staging folder first; only after that commit succeeds is the old folder
    renamed away and the staging folder renamed into place. ``batch_id`` is
    recorded inside the new folder (an ``_``-prefixed marker readers ignore),
    so it becomes visible together with the data it produced.
    """
    spark = df.sparkSession
    recover_table(spark, path)
    tag = uuid.uuid4().hex[:12]
    staging, retired = f"{path}__staging_{tag}", f"{path}__retired_{tag}"
    writer = df.write.mode("overwrite").format(fmt)
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.save(staging)
    fs, target = _fs(spark, path)
    jvm = spark._jvm
    if batch_id is not None:
        fs.create(jvm.org.apache.hadoop.fs.Path(f"{staging}/{MARKER_PREFIX}{batch_id}" + (f"_{stream_id}" if stream_id else ""))).close()
    had_old = fs.exists(target)
    if had_old and not fs.rename(target, jvm.org.apache.hadoop.fs.Path(retired)):
        raise IOError(f"could not move {path} aside")
    parent = target.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(staging), target):
        if had_old:
            fs.rename(jvm.org.apache.hadoop.fs.Path(retired), target)
        raise IOError(f"could not publish {staging} to {path}")
    if had_old:
        fs.delete(jvm.org.apache.hadoop.fs.Path(retired), True)
    return path
