"""Keyed upsert of a staging table into a stored table, and keyed REPLACE.

Semantics of ``upsert(stg, ods, keys, mode="join")`` (a full outer join on the
key where the staging row wins whole):

* every stored row whose key has no staging row is kept;
* every staging row is kept, repeated once per stored row with its key
  (at least once). Duplicate keys on both sides thus fan out m x n.

The plan never pairs rows: stored rows are counted per key (map-side partial
aggregation, so a hot key costs one row per task), staging rows are joined to
that count (one row per key on the build side) and repeated, the copies of one
row by many tasks when they are many; stored rows without a staging key are
kept with an anti join. With few staging keys
(measured) everything on the stored side is map-side; otherwise AQE splits a
skewed staging or stored partition in both joins.

``mode="replace"`` (anti join + union) is the same result whenever every
stored key that staging matches is unique, and cheaper: no count.

Keys compare null-safely; string keys treat NULL and "" as the same key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareflow.operators.keys import per_key
from wareflow.operators.measure import BROADCAST_BYTES_MAX, BROADCAST_ROWS_MAX, fits_broadcast


def _key_exprs(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Non-null key columns whose plain equality is the null-safe key match.

    A string key becomes ``coalesce(k, '')`` (NULL and "" are the same key).
    Any other key becomes ``coalesce(k, <zero>)`` plus ``isnull(k)``. Plain
    equality on these lets the distinct/count aggregates and the joins share
    one hash partitioning (a ``<=>`` join would re-shuffle on its own form).
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for k in keys:
        c, t = F.col(f"`{k}`"), fields[k]
        if isinstance(t, T.StringType):
            out.append(F.coalesce(c, F.lit("")))
        elif isinstance(t, (T.NumericType, T.BooleanType)):
            out += [F.coalesce(c, F.lit(0).cast(t)), c.isNull()]
        else:
            out += [F.coalesce(c.cast("string"), F.lit("")), c.isNull()]
    return out


def _keyed(df: DataFrame, keys: Sequence[str], prefix: str) -> tuple[DataFrame, list[str]]:
    exprs = _key_exprs(df, keys)
    names = [f"{prefix}{i}" for i in range(len(exprs))]
    return df.withColumns(dict(zip(names, exprs))), names


def _cond(left: DataFrame, lnames, right: DataFrame, rnames) -> Column:
    cond = None
    for a, b in zip(lnames, rnames):
        c = left[a] == right[b]
        cond = c if cond is None else cond & c
    return cond


# Staging keys are broadcast when their measured size is within both bounds:
# a key count and the bytes of the hash table they would fill.
BROADCAST_KEYS_MAX = BROADCAST_ROWS_MAX
BROADCAST_KEYS_MAX_BYTES = BROADCAST_BYTES_MAX


def staging_keys(stg: DataFrame, keys: Sequence[str], prefix: str = "__sk") -> tuple[DataFrame, list[str]]:
    """Distinct normalised staging keys (aggregated: one row per key)."""
    keyed, names = _keyed(stg, keys, prefix)
    return per_key(keyed, names), names


def keep_unmatched(ods: DataFrame, stg: DataFrame, keys: Sequence[str],
                   broadcast_keys: bool = False) -> DataFrame:
    """Stored rows whose key no staging row has."""
    okeyed, onames = _keyed(ods, keys, "__ok")
    skeys, snames = staging_keys(stg, keys)
    if broadcast_keys:
        skeys = F.broadcast(skeys)
    kept = okeyed.join(skeys, _cond(okeyed, onames, skeys, snames), "left_anti")
    return kept.drop(*onames)


def _few_staging_keys(stg: DataFrame, keys: Sequence[str], bound: int | None,
                      max_bytes: int | None = None) -> bool:
    """True when the distinct staging keys number at most ``bound`` and their
    hash table takes at most ``max_bytes`` (both measured in one aggregation
    over the staging side, the small side of a merge)."""
    if not bound:
        return False
    skeys, _ = staging_keys(stg, keys)
    return fits_broadcast(skeys, bound, BROADCAST_KEYS_MAX_BYTES if max_bytes is None else max_bytes)


#: Copies of a staging row made by one task at a time.
FAN_OUT = 1 << 16


def _copies(rows: DataFrame, cols: Sequence[Column]) -> DataFrame:
    """Rows with at most FAN_OUT copies (``__times``), repeated where they stand."""
    return rows.select(*cols, F.explode(F.sequence(F.lit(1).cast("long"), F.col("__times"))).alias("__copy")).drop("__copy")


def _spread_copies(rows: DataFrame, cols: Sequence[Column]) -> DataFrame:
    """Rows with more copies than FAN_OUT: a row becomes its chunk numbers, the chunks
    are dealt over all tasks, and each task makes the copies of its chunks."""
    fan = F.lit(FAN_OUT).cast("long")
    numbers = F.sequence(F.lit(0).cast("long"), F.floor((F.col("__times") - 1) / fan))
    chunks = rows.select(*cols, "__times", F.explode(numbers).alias("__chunk"))
    dealt = chunks.repartition(F.xxhash64(*cols, "__chunk"))
    here = F.least(fan, F.col("__times") - F.col("__chunk") * fan)
    return _copies(dealt.select(*cols, here.alias("__times")), cols)


def upsert(stg: DataFrame, ods: DataFrame, keys: Sequence[str],
           mode: str = "join", broadcast_keys_max: int | None = BROADCAST_KEYS_MAX,
           new_columns: str = "fail") -> DataFrame:
    """Upsert ``stg`` into ``ods`` on ``keys``; output has ``ods``'s columns.

    Staging columns that the stored side lacks fail, or, with
    ``new_columns="add"``, follow its columns (NULL in stored rows). Staging
    must have every stored column.

    Two plans, chosen by measuring the distinct staging keys:

    * at most ``broadcast_keys_max`` keys taking at most
      ``BROADCAST_KEYS_MAX_BYTES`` (a daily drop into a large table):
      the keys are broadcast; stored rows are filtered map-side (anti join for
      the kept rows, semi join before counting the matched ones) and the
      per-key counts (no more rows than keys) are broadcast to the staging
      rows. The stored table is never shuffled.
    * more: every side is hash-partitioned on the normalised key; the stored
      keys are counted with a map-side partial aggregation first, and AQE
      splits hot partitions of both joins.

    ``broadcast_keys_max=None`` skips the measurement (always the second plan).
    """
    if mode not in ("join", "replace"):
        raise ValueError("mode must be 'join' or 'replace'")
    keys = list(keys)
    have, bring = {c.lower() for c in ods.columns}, {c.lower() for c in stg.columns}
    lost = [c for c in ods.columns if c.lower() not in bring]
    if lost:
        raise ValueError(f"staging lacks the stored columns {lost}")
    added = [f for f in stg.schema.fields if f.name.lower() not in have]
    if added and new_columns != "add":
        raise ValueError(f"staging has columns that the stored table lacks: {[f.name for f in added]}; "
                         "new_columns='add' adds them")
    ods = ods.select(*[F.col(f"`{c}`") for c in ods.columns],
                     *[F.lit(None).cast(f.dataType).alias(f.name) for f in added])
    stg = stg.select(*[F.col(f"`{c}`") for c in ods.columns])
    small = _few_staging_keys(stg, keys, broadcast_keys_max)
    kept = keep_unmatched(ods, stg, keys, broadcast_keys=small)
    if mode == "replace":
        return kept.unionByName(stg)
    okeyed, onames = _keyed(ods, keys, "__ok")
    if small:
        skeys, snames = staging_keys(stg, keys)
        skeys = F.broadcast(skeys)
        okeyed = okeyed.join(skeys, _cond(okeyed, onames, skeys, snames), "left_semi")
    counts = per_key(okeyed, onames, F.count(F.lit(1)).alias("__n"))
    if small:
        counts = F.broadcast(counts)
    skeyed, snames = _keyed(stg, keys, "__sk")
    joined = skeyed.join(counts, _cond(skeyed, snames, counts, onames), "left")
    cols = [F.col(f"`{c}`") for c in ods.columns]
    times = F.greatest(F.coalesce(F.col("__n"), F.lit(0)), F.lit(1))
    few = joined.select(*cols, times.alias("__times")).where(F.col("__times") <= FAN_OUT)
    # Keys with more stored rows than FAN_OUT are few; their staging rows' copies are dealt over the tasks.
    often = counts.where(F.col("__n") > FAN_OUT)
    many = skeyed.join(often, _cond(skeyed, snames, often, onames)).select(*cols, F.col("__n").alias("__times"))
    return kept.unionByName(_copies(few, cols)).unionByName(_spread_copies(many, cols))


def replace_into(existing: DataFrame, incoming: DataFrame, pk: Sequence[str],
                 order_by: Sequence[str] | None = None,
                 broadcast_keys_max: int | None = BROADCAST_KEYS_MAX) -> DataFrame:
    """Keyed REPLACE: the last incoming row per key replaces the stored one.

    "Last" is the greatest ``order_by`` value (ties broken by the whole row,
    so the choice is deterministic). Picking it is a partial aggregation per
    key, not a window sort, so a key holding a large share of the batch is
    reduced map-side before the shuffle. Columns follow ``existing``. When the
    batch has at most ``broadcast_keys_max`` keys (measured), they are
    broadcast and the stored table is filtered map-side.
    """
    pk = list(pk)
    cols = existing.columns
    order_by = list(order_by or [])
    row = F.struct(*[F.col(f"`{c}`") for c in cols]).alias("r")
    ranked = F.struct(*[F.col(f"`{c}`") for c in order_by], row)
    keyed, names = _keyed(incoming, pk, "__k")   # NULL and "" are one string key here too
    last = (keyed.groupBy(*names)
            .agg(F.max(ranked).alias("m"))
            .select("m.r.*"))
    small = _few_staging_keys(last, pk, broadcast_keys_max)
    return keep_unmatched(existing, last, pk, broadcast_keys=small).unionByName(last)
