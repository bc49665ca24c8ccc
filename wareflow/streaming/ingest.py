"""Incremental staging ingest with Structured Streaming.

The partition job is scheduled to run periodically over whatever staging
drops have arrived. As a stream: a file source over the staging drops, a
trigger that processes everything new and stops (``availableNow``, one run
per schedule tick). A ``foreachBatch`` sink gathers the run's micro-batches in a
pending folder beside the checkpoint, each under its own batch level, so that
a repeated batch replaces itself. When the stream has stopped, the pending rows
are published as one: how the drops fall into micro-batches does not matter.

Progress (which files were consumed) lives in a checkpoint folder below the
session's ``spark.checkpoint.dir``, so a restarted run skips consumed drops.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wareflow.functions.spec import split_pairs
from wareflow.operators.partition import with_levels, with_prt_path
from wareflow.session import checkpoint_root, configure
from wareflow.operators.upsert import upsert
from wareflow.sinks.files import (add_files, applied_batch, move_folder, path_exists, publish_table,
                                  recover_table, retire_folder, write_partitioned)
from wareflow.sources.text import read_staging


def staging_stream(spark: SparkSession, drops_glob: str, sample_drop: str,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame over staging CSV drops (header per file, all strings).

    The column names come from one drop's header (file streams need a fixed
    schema); blank names become ``NA_<position>``.
    """
    names = read_staging(spark, sample_drop, check_header=False).columns
    schema = ", ".join(f"`{n}` string" for n in names)
    # Without enforceSchema Spark fails on a drop whose header differs. Filled
    # names stand in no header, so drops with blank names are not checked.
    filled = names != read_staging(spark, sample_drop, check_header=False, fill_blank=False).columns
    reader = (spark.readStream.schema(schema).option("header", "true").option("sep", ",")
              .option("quote", "").option("enforceSchema", str(filled).lower()))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.csv(drops_glob)


def ingest_partitions(spark: SparkSession, drops_glob: str, sample_drop: str, target: str,
                      prt_spec=None, checkpoint: str | None = None, fmt: str = "parquet",
                      max_files_per_trigger: int | None = None) -> str:
    """Run the staging -> partitioned table ingest once over all new drops.

    ``prt_spec`` is ``[[":name", index], ...]`` like the partition job's. Every
    drop's rows are added once, to the partitions that they name (or to a table
    without levels), so the table holds the rows of all drops however they
    fall into triggers and runs. A run that died is finished by the next one:
    before the stream stopped, its micro-batches join the next run's; after
    that, they are published first, as they were. Without levels a table
    belongs to one checkpoint; another one fails.
    Returns the checkpoint folder (reuse it for the next run).
    """
    configure(spark)
    if not checkpoint:
        tag = hashlib.sha1(target.encode()).hexdigest()[:16]  # stable across restarts
        checkpoint = f"{checkpoint_root(spark)}/wareflow/streams/{tag}"
    stream = staging_stream(spark, drops_glob, sample_drop, max_files_per_trigger)
    names, idx = split_pairs(prt_spec or [])
    cols = stream.columns

    pending, ready = f"{checkpoint}__pending", f"{checkpoint}__ready"
    staged, moving = f"{checkpoint}__staged", f"{checkpoint}__moving"

    def gather(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{pending}/{BATCH}={batch_id}")

    def publish() -> None:
        if path_exists(spark, moving):           # holds all ready rows, or what is left of them
            if path_exists(spark, ready):
                retire_folder(spark, ready)
            add_files(spark, moving, target, len(names))
        if not path_exists(spark, ready):
            return
        found = spark.read.schema(", ".join([*(f"`{c}` string" for c in cols), f"`{BATCH}` long"])).parquet(ready)
        rows = found.drop(BATCH)
        spec = [(n, F.col(f"`{cols[i]}`")) for n, i in zip(names, idx)]
        if names:
            # The rows of the run are written aside; the rename commits them, their files then move to the table.
            write_partitioned(with_levels(rows, spec), staged, names, fmt=fmt, dynamic=False)
            move_folder(spark, staged, moving)
            retire_folder(spark, ready)
            add_files(spark, moving, target, len(names))
            return
        recover_table(spark, target)
        last, owner = found.agg(F.max(BATCH)).first()[0], _stream_id(spark, checkpoint)
        rows = with_prt_path(rows, spec)
        if last is not None and last > applied_batch(spark, target, owner):
            if path_exists(spark, target):
                rows = spark.read.format(fmt).load(target).unionByName(rows)
            publish_table(rows, target, fmt=fmt, batch_id=last, stream_id=owner)
        retire_folder(spark, ready)

    publish()
    query = (stream.writeStream.foreachBatch(gather)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if path_exists(spark, pending):
        move_folder(spark, pending, ready)
        publish()
    return checkpoint


#: Directory level of a micro-batch in the pending folder.
BATCH = "wareflow_batch"


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream of this checkpoint when it first started."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def merge_batch(spark: SparkSession, batch: DataFrame, batch_id: int, target: str,
                keys, mode: str = "replace", fmt: str = "parquet", stream_id: str = "") -> bool:
    """Upsert one micro-batch into the stored table at ``target``, exactly once.

    The batch id and the stream it counts in are published with the table (see
    ``publish_table``); a batch whose id the table already records is skipped,
    so a retried batch is not applied twice. A table that another stream
    filled fails. Returns whether the batch was applied.
    """
    recover_table(spark, target)
    if batch_id <= applied_batch(spark, target, stream_id):
        return False
    if path_exists(spark, target):
        stored = spark.read.format(fmt).load(target)
    else:
        stored = spark.createDataFrame([], batch.schema)
    publish_table(upsert(batch, stored, keys, mode=mode), target, fmt=fmt, batch_id=batch_id,
                  stream_id=stream_id)
    return True


def ingest_merge(spark: SparkSession, drops_glob: str, sample_drop: str, target: str,
                 keys, mode: str = "replace", checkpoint: str | None = None,
                 fmt: str = "parquet", max_files_per_trigger: int | None = None) -> str:
    """Run the staging -> stored-table merge once over all new drops.

    Each micro-batch is upserted on ``keys`` (names) and the table published
    by swap. ``mode="replace"`` is the default because it is idempotent per
    key; together with the recorded batch id every drop is applied once. The
    table belongs to one checkpoint: a run with another one fails.
    Returns the checkpoint folder (reuse it for the next run).
    """
    configure(spark)
    if not checkpoint:
        tag = hashlib.sha1(("merge:" + target).encode()).hexdigest()[:16]
        checkpoint = f"{checkpoint_root(spark)}/wareflow/streams/{tag}"
    stream = staging_stream(spark, drops_glob, sample_drop, max_files_per_trigger)
    keys = [k.lstrip(":") if isinstance(k, str) else stream.columns[int(k[1])] for k in keys]

    def apply(batch: DataFrame, batch_id: int) -> None:
        merge_batch(spark, batch, batch_id, target, keys, mode=mode, fmt=fmt,
                    stream_id=_stream_id(spark, checkpoint))

    query = (stream.writeStream.foreachBatch(apply)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return checkpoint
