"""One-row-per-key aggregates meant to be joined against a possibly skewed side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def per_key(df: DataFrame, names: Sequence[str], *aggs: Column) -> DataFrame:
    """One row per key (distinct keys, or ``aggs`` per key), ready to be joined
    against a skewed side.

    The grouping also carries a hash of the key, dropped afterwards, so the
    result is not already partitioned the way the join wants: the join then
    re-shuffles this one-row-per-key side, both join inputs are plain shuffle
    stages, and AQE can split a hot key's partition of the other side (it
    cannot when an aggregate feeds the join directly).
    """
    cols = [F.col(n) for n in names]
    grouped = df.groupBy(*cols, F.xxhash64(*cols).alias("__h"))
    out = grouped.agg(*aggs) if aggs else grouped.agg(F.count(F.lit(1)).alias("__drop"))
    return out.drop("__h", "__drop")
