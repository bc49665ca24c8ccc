"""External tables in the session catalog (K6, K7, K8)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _ident(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


DELIMITED_OPTIONS = {"sep": "\u0001", "quote": "", "header": "false"}


def external_table_ddl(name: str, columns: list[str], partitions: list[str] | None,
                       location: str, fmt: str = "parquet") -> str:
    """``CREATE TABLE IF NOT EXISTS`` with all-string columns over ``location``.

    ``fmt="delimited"`` is headerless ``\x01`` text (a CSV table with that
    separator and no quoting).
    """
    parts = list(partitions or [])
    cols = ", ".join(f"`{c}` STRING" for c in [*columns, *parts])
    using = "csv" if fmt == "delimited" else fmt
    ddl = f"CREATE TABLE IF NOT EXISTS {_ident(name)} ({cols}) USING {using}"
    if fmt == "delimited":
        ddl += " OPTIONS (" + ", ".join(f"'{k}' '{v}'" for k, v in DELIMITED_OPTIONS.items()) + ")"
    if parts:
        ddl += " PARTITIONED BY (" + ", ".join(f"`{p}`" for p in parts) + ")"
    return ddl + f" LOCATION '{location}'"


def ensure_external_table(spark: SparkSession, name: str, columns: list[str],
                          partitions: list[str] | None, location: str,
                          fmt: str = "parquet") -> None:
    """Create the table if absent (database too); an existing table is kept.

    File listings that the session cached for the table or its folder are dropped.
    """
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name.split('.')[0]}`")
    spark.sql(external_table_ddl(name, columns, partitions, location, fmt))
    spark.catalog.refreshTable(_ident(name))
    spark.catalog.refreshByPath(location)


def repair(spark: SparkSession, name: str) -> None:
    """Register partitions that exist on storage but not in the catalog."""
    spark.catalog.recoverPartitions(name)
