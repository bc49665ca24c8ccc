"""Measuring a side before it is broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bounds of a broadcast side: its rows, and the memory of its hash table. Every task that reads the side holds
#: the table, which Spark grows in powers of two to a few times this size, and a plan may hold several.
BROADCAST_ROWS_MAX = 1_000_000
BROADCAST_BYTES_MAX = 64 * 1024 * 1024
#: What a row costs besides its values: the row's own words and its slot in the table.
ROW_BYTES = 48


def _width(field: T.StructField) -> Column:
    """Bytes of a value in a row: exact for text, an upper bound for fixed widths, printed size for the rest."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.lit(16) + F.coalesce(F.octet_length(c), F.lit(0))
    if isinstance(field.dataType, T.DecimalType):
        return F.lit(24)
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.lit(32) + 2 * F.coalesce(F.octet_length(F.to_json(c)), F.lit(0))
    return F.lit(8)


def measured(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes of the hash table that a broadcast of ``df`` would build); one aggregation, nothing collected."""
    size = F.lit(ROW_BYTES)
    for field in df.schema.fields:
        size = size + _width(field)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size.cast("long")), F.lit(0)).alias("bytes")).first()
    return row["n"], row["bytes"]


def fits_broadcast(df: DataFrame, max_rows: int | None = BROADCAST_ROWS_MAX,
                   max_bytes: int = BROADCAST_BYTES_MAX) -> bool:
    """Whether ``df`` is measured to be within both bounds (``max_rows=None``: not measured, no)."""
    if not max_rows:
        return False
    rows, size = measured(df)
    return rows <= max_rows and size <= max_bytes
