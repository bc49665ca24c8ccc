"""Text sources: line scans, staging CSV, ``\\x01`` rows, header checks.

All readers are splittable line readers (never whole-file reads), so a large
staging drop spreads across as many tasks as it has blocks. Headers are read by
opening each file for its first line alone.
"""

from __future__ import annotations

from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareflow.functions.columns import bind_fields, filled_names
from wareflow.functions.spec import fill_header
from wareflow.operators.measure import fits_broadcast

CTRL_A = "\x01"


def read_lines(spark: SparkSession, path: str, with_file: bool = False) -> DataFrame:
    """Every line of every file below ``path`` (nested folders included)."""
    df = spark.read.option("recursiveFileLookup", "true").text(path)
    if with_file:
        df = df.select("value", F.col("_metadata.file_path").alias("file_path"))
    return df


def read_staging(spark: SparkSession, path: str, check_header: bool = True,
                 fill_blank: bool = True, strict_single_file: bool = False) -> DataFrame:
    """Staging CSV: comma separated, header line per file, all strings, no quoting.

    With ``check_header`` every file's header must name the same columns as the
    schema (Spark validates each file while scanning, no extra pass); a file
    that disagrees fails the job. Header names that are empty or white space become
    ``NA_<position>``. Blank lines are skipped; empty fields read as NULL.
    ``strict_single_file`` also fails unless the drop is exactly one file.
    """
    def reader(enforce: bool):
        r = (spark.read.option("header", "true").option("sep", ",")
             .option("quote", "").option("inferSchema", "false")
             .option("recursiveFileLookup", "true"))
        return r if enforce else r.option("enforceSchema", "false")

    if strict_single_file:
        assert_single_header(spark, path, strict_single_file=True)
    df = reader(True).csv(path)
    blank = [not c.strip() or c == f"_c{i}" for i, c in enumerate(df.columns)]
    if any(blank):
        # Spark names empty header cells _c<i>, as a cell may spell itself: the raw lines tell. Its own
        # check would then reject every file, so the raw lines are compared too.
        heads = header_lines(spark, path)
        if check_header and len(heads) != 1:
            raise ValueError(HEADER_MISMATCH)
        cells = heads[0].split(",")
        blank = [not c.strip() for c in cells[:len(df.columns)]] + [True] * (len(df.columns) - len(cells))
    if check_header and not any(blank):
        # Same names, now checked against every file's header during the
        # scan; the schema is passed on so it is not inferred again.
        df = reader(False).schema(df.schema).csv(path)
    if fill_blank and any(blank):
        df = df.toDF(*fill_header([None if b else c for b, c in zip(blank, df.columns)]))
    return df


#: Schemes of the paths whose files a task can open by itself; other paths are read by Spark's line reader.
OPENED_SCHEMES = ("file", "hdfs", "s3", "s3a", "gs", "abfs")
FIRST_READ = 1 << 16


def first_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, line): the first line of every file below ``path`` that has one.

    The listed files are dealt over the tasks; each task opens its files and
    reads up to the first line break (``FIRST_READ`` bytes at a time), so the
    bytes read do not grow with the files. Compressed files are told by their
    extension. Paths of other file systems than ``OPENED_SCHEMES`` are read by
    Spark's line reader, whole.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select("path", "_metadata.file_path"))             # listed, not opened
    scheme = urlparse(path).scheme or urlparse(spark._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(
        spark._jsc.hadoopConfiguration()).toString()).scheme or "file"
    if scheme not in OPENED_SCHEMES:
        tagged = tag_rows(read_lines(spark, path)).where(F.col("_block_start") == 0)
        return tagged.groupBy("file_path").agg(F.min_by("value", "_rid").alias("line"))
    size = FIRST_READ

    def heads(batches):
        import pyarrow as pa
        from pyarrow import fs

        def first(uri: str) -> str | None:
            if uri.startswith("file:"):
                store, at = fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
            else:
                store, at = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
            held = b""
            with store.open_input_stream(at) as f:
                while more := f.read(size):
                    held += more
                    if b"\n" in more or b"\r" in more:
                        break
            line = held.replace(b"\r", b"\n").split(b"\n", 1)[0].removeprefix(b"\xef\xbb\xbf")
            return line.decode("utf-8", "replace") if held else None

        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(1), pa.array([first(u) for u in b.column(0).to_pylist()], pa.string())], names=["file_path", "line"])

    return files.mapInArrow(heads, "file_path string, line string").where("line IS NOT NULL")


def header_lines(spark: SparkSession, path: str) -> list[str]:
    """The distinct first lines below ``path``, two at most (two already differ)."""
    return sorted(r["line"] for r in first_lines(spark, path).select("line").distinct().limit(2).collect())


HEADER_MISMATCH = "data header didn't match!"


def check_headers(spark: SparkSession, path: str) -> DataFrame:
    """One row: number of files with a line and number of distinct header lines.

    Only first lines are read (:func:`first_lines`); no file content reaches the driver.
    """
    return first_lines(spark, path).agg(F.count("*").alias("n_files"),
                                        F.count_distinct("line").alias("n_headers"))


def assert_single_header(spark: SparkSession, path: str,
                         strict_single_file: bool = False) -> None:
    """Fail unless all files carry the same header.

    ``strict_single_file=True`` is the literal rule of counting header lines,
    one per file: anything but exactly one file fails, even with equal headers.
    """
    row = check_headers(spark, path).first()
    if row is None or row["n_headers"] != 1 or (strict_single_file and row["n_files"] != 1):
        raise ValueError(HEADER_MISMATCH)


def split_fields(line: F.Column, names: list[str], sep: str = CTRL_A) -> list[F.Column]:
    """Positional fields of ``line``: empty stays ``""``, missing is NULL."""
    parts = F.split(line, _regex_quote(sep), -1)
    return [F.get(parts, i).alias(n) for i, n in enumerate(names)]


def _regex_quote(sep: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\/" else ch for ch in sep)


def read_delimited(spark: SparkSession, path: str, names: list[str],
                   sep: str = CTRL_A) -> DataFrame:
    """Headerless delimited rows with positional names, all strings.

    Short rows give NULL for the missing trailing columns, extra fields are
    ignored, blank lines are skipped.
    """
    lines = read_lines(spark, path).where(F.col("value") != "")
    return lines.select(*split_fields(F.col("value"), names, sep))


def tag_rows(lines: DataFrame) -> DataFrame:
    """Add ``file_path``, ``_block_start`` and a row id ``_rid`` to a line scan.

    Within one split the rows of a file are contiguous and their ids grow by
    one in read order; the ids are recomputed identically on a retry.
    """
    return lines.select(
        "*",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("_block_start"),
        F.monotonically_increasing_id().alias("_rid"))


def skip_rows(tagged: DataFrame, n: int) -> DataFrame:
    """Drop the first ``n`` lines of every file of a :func:`tag_rows` scan."""
    at_start = F.when(F.col("_block_start") == 0, F.xxhash64("file_path"))
    return _without_first(tagged, at_start, n)


def read_data_lines(spark: SparkSession, path: str, skip: int) -> DataFrame:
    """The lines (``value``) of all files below ``path``, without the first ``skip`` of each."""
    at_start = F.when(F.col("_metadata.file_block_start") == 0, F.xxhash64("_metadata.file_path"))
    return _without_first(read_lines(spark, path), at_start, skip)


def _without_first(lines: DataFrame, at_start: F.Column, n: int) -> DataFrame:
    """A line scan without the first ``n`` rows of each file; one pass, nothing is shuffled.

    Must follow the scan itself: a task sees the rows of a split together and in
    order, and a file's first lines stand in the split that starts at 0 (they
    must be shorter than a split). ``at_start`` names the file there, and is
    NULL in other splits. A task only counts rows since the file's name changed.
    """
    if n <= 0:
        return lines

    def drop(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        here, seen = None, 0
        for b in batches:
            names = b.column(b.num_columns - 1)
            rest = b.select(list(range(b.num_columns - 1)))
            runs = pc.run_end_encode(names)
            at = 0
            for name, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                if name != here:
                    here, seen = name, 0
                skip = max(0, min(n - seen, end - at)) if name is not None else 0
                if end > at + skip:
                    yield rest.slice(at + skip, end - at - skip)
                seen += end - at
                at = end

    return lines.select("*", at_start.alias("__file")).mapInArrow(drop, lines.schema)


def read_bound(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """(file_path, fields) of every data line below ``path``, whatever its file's columns are.

    ``fields`` is an array of (name, value): the file's own header line bound to
    the line's fields by position, at run time, so that files of a drop may
    differ in their columns and the driver knows none of them. Blank header
    names are ``NA_<position>``, missing fields NULL; fields beyond the header are
    left out, blank lines skipped. The headers (one row a file) are broadcast
    when they are measured to be small.
    """
    heads = first_lines(spark, path).select(F.col("file_path").alias("__head"), filled_names(
        F.split("line", _regex_quote(sep), -1)).alias("__names"))
    if fits_broadcast(heads, HEADS_MAX):
        heads = F.broadcast(heads)
    lines = skip_rows(tag_rows(read_lines(spark, path)), 1).where(F.col("value") != "")
    bound = bind_fields(F.col("__names"), F.split("value", _regex_quote(sep), -1))
    return (lines.join(heads, F.col("file_path") == F.col("__head"))
            .select("file_path", bound.alias("fields")))


#: Most files whose headers are broadcast.
HEADS_MAX = 1_000_000


def read_feature_json(spark: SparkSession, path: str,
                      schema: T.StructType | None = None) -> DataFrame:
    """Feature JSON tables (``name=value`` folders become string columns).

    Pass the schema when known: inference is a full extra pass over the data.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)
