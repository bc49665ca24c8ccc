"""Tables whose rows name different lists of partition levels.

A folder of ``name=value`` directories has one list of level names; Spark reads
no folder that mixes ``p=1`` and ``q=2``. A table's first list of levels (the
longest of its first run) is its home layout, at the root. Rows that name
another list go to a folder of that list below the root, ``levels.<name>.<name>``,
and :func:`read_feature_table` unions them, the levels that a row lacks being NULL.

Several layouts are published as one: all are staged, the staged tree is renamed to
a ready folder (the commit point), and its partition folders are moved into place. A driver
that dies while moving leaves the rest in the ready folder; :func:`finish_layouts`,
which every run calls first, moves it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareflow.operators.partition import names_of
from wareflow.sinks.files import _fs, move_folder, path_exists, write_feature_json

PREFIX = "levels."


def layout_folder(names: Sequence[str]) -> str:
    """``["p", "q"]`` -> ``levels.p.q`` (names quoted, so that a dot parts them)."""
    return PREFIX + ".".join(quote(n, safe="").replace(".", "%2E") for n in names)


def _folders(spark: SparkSession, pattern: str) -> list[str]:
    fs, jpath = _fs(spark, pattern)
    return sorted(st.getPath().toString() for st in (fs.globStatus(jpath) or []) if st.isDirectory())


def home_layout(spark: SparkSession, path: str) -> list[str]:
    """Level names of the ``name=value`` directories at the root, from the first branch ([]: none)."""
    names, at = [], path
    while found := _folders(spark, f"{at}/*=*"):
        at = found[0]
        names.append(unquote(at.rsplit("/", 1)[-1].split("=", 1)[0]))
    return names


def stored_layouts(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """(folder, level names) of every layout stored at ``path``."""
    home = home_layout(spark, path)
    out = [(path, home)] if home else []
    for folder in _folders(spark, f"{path}/{PREFIX}*"):
        parts = folder.rsplit("/", 1)[-1][len(PREFIX):].split(".")
        out.append((folder, [unquote(p) for p in parts]))
    return out


def write_layouts(df: DataFrame, path: str, layouts: Sequence[Sequence[str]], hidden: bool = False,
                  files_per_partition: int | None = None) -> str:
    """JSON lines of rows with several lists of level names (``prt_path`` spells each row's); the partitions
    that the rows name are replaced, all others stay. Rows with a blank path take the default partition of
    the first list."""
    spark = df.sparkSession
    finish_layouts(spark, path)
    staging = f"{path}__staging_{uuid.uuid4().hex[:12]}"
    for layout in layouts:
        mine = names_of() == F.lit(list(layout))
        if layout is layouts[0]:
            mine = mine | (F.size(names_of()) == 0)
        write_feature_json(df.where(mine), f"{staging}/{layout_folder(layout)}", list(layout), hidden=hidden,
                           files_per_partition=files_per_partition)
    move_folder(spark, staging, f"{path}__ready")
    finish_layouts(spark, path)
    return path


def finish_layouts(spark: SparkSession, path: str) -> None:
    """Move the partition folders of the ready folder, if there is one, into place."""
    ready = f"{path}__ready"
    if not path_exists(spark, ready):
        return
    fs, _ = _fs(spark, path)
    as_path = spark._jvm.org.apache.hadoop.fs.Path
    folders = sorted(_folders(spark, f"{ready}/{PREFIX}*"), key=lambda f: (-f.rsplit("/", 1)[-1].count("."), f))
    stored = stored_layouts(spark, path)
    home = layout_folder(home_layout(spark, path)) if stored or not folders else folders[0].rsplit("/", 1)[-1]
    for folder in folders:
        name = folder.rsplit("/", 1)[-1]
        depth = name.count(".")
        for leaf in _folders(spark, folder + "/*=*" * depth):
            below = "/".join(leaf.split("/")[-depth:])
            target = as_path(f"{path}/{below}" if name == home else f"{path}/{name}/{below}")
            fs.mkdirs(target.getParent())
            fs.delete(target, True)
            if not fs.rename(as_path(leaf), target):
                raise IOError(f"could not move {leaf} to {target}")
    fs.delete(as_path(ready), True)


def read_feature_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A feature JSON table of any number of layouts: ``schema``'s columns, then every level that some layout
    has (in order of first mention) as text, NULL where a row's layout lacks it.

    ``schema`` describes the records; levels that it lists too are read as levels.
    """
    layouts = stored_layouts(spark, path)
    levels = list(dict.fromkeys(n for _, names in layouts for n in names))
    record = T.StructType([f for f in schema.fields if f.name not in levels])
    out = None
    for folder, names in layouts:
        full = T.StructType(record.fields + [T.StructField(n, T.StringType()) for n in names])
        rows = (spark.read.schema(full).option("basePath", folder).json(f"{folder}/{names[0]}=*"))
        rows = rows.select(*record.names, *[F.col(f"`{n}`") if n in names else F.lit(None).cast("string").alias(n)
                                            for n in levels])
        out = rows if out is None else out.unionByName(rows)
    return out if out is not None else spark.read.schema(schema).json(path)
