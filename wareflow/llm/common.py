"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from wareflow.session import scratch_path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def kept(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written as Parquet below the shared folder and read back (a lineage cut)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._kept_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the folders of :func:`kept` tables that nothing reads any more: whatever was made of them is written."""
    for t in tables:
        jvm = t.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(t._kept_at)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def filesystem(uri: str):
    """(pyarrow file system, path) of a folder in the shared store, from any machine."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def put_file(uri: str, name: str, *parts) -> None:
    """Write a file under a name of this attempt and move it into place: a retried task replaces it whole."""
    from pyspark import TaskContext
    store, path = filesystem(uri)
    store.create_dir(path, recursive=True)
    task = TaskContext.get()
    tmp = f"{path}/.{name}.{task.taskAttemptId() if task else os.getpid()}"
    with store.open_output_stream(tmp) as out:
        for part in parts:
            out.write(part)
    store.move(tmp, f"{path}/{name}")


def release() -> None:
    """Give memory that this process has freed back to the machine: the allocators keep it otherwise, and Python workers live
    on from stage to stage beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # of glibc alone
    if trim:
        trim(0)


def tidy(run):
    """``run``, a function over the Arrow batches of a task, that ends with :func:`release`."""
    @wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release()
    wrapped.releases = True
    return wrapped


def binary(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([a.tobytes() for a in arrays], pa.binary())


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    cols = [c if isinstance(c, pa.Array) else pa.array(c, f.type, from_pandas=False)
            for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(cols, schema=schema)


def local_rows(spark: SparkSession, rows: list[tuple], *names: str) -> DataFrame:
    """A few rows of the driver, whole numbers all, as a table. They go as Arrow, so that no task starts a Python worker for them."""
    columns = list(zip(*rows)) or [[]] * len(names)
    return spark.createDataFrame(pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)}))


def ship(spark: SparkSession) -> SparkSession:
    """Give the package to the Python workers, once per context (like spark-submit --py-files)."""
    import tempfile
    import zipfile
    from pathlib import Path

    sc = spark.sparkContext
    if not getattr(sc, "_wareflow_shipped", False):
        top = Path(__file__).resolve().parents[1]
        name = os.path.join(tempfile.mkdtemp(prefix="wareflow-src-"), "wareflow_src.zip")   # read by the driver alone
        with zipfile.ZipFile(name, "w") as z:
            for p in sorted(top.rglob("*.py")):
                z.write(p, p.relative_to(top.parent))
        sc.addPyFile(name)
        sc._wareflow_shipped = True
    return spark
