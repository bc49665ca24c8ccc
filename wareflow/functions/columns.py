"""Scalar column functions shared by the operators.

``MMMyy`` month names (parse with a fixed century window, format, month
index), the names of a KPI column's comparison periods, report tree keys, and header
names bound to fields by position.
All are built-in Spark expressions (no Python per row).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CENTURY_START = 1950


def parse_month(text: Column, century_start: int = CENTURY_START) -> Column:
    """``Jan95`` / ``JAN95`` -> first day of that month (DATE).

    A two-digit year falls in ``[century_start, century_start + 99]``
    (95 -> 1995, 01 -> 2001 by default); Spark's own ``yy`` would read
    every two-digit year as 20yy.
    """
    t = F.initcap(F.trim(text))
    month = F.month(F.to_date(F.concat(F.lit("2000"), F.substring(t, 1, 3)), "yyyyMMM"))
    yy = F.substring(t, 4, 2).cast("int")
    base = century_start - century_start % 100
    year = F.lit(base) + yy
    year = F.when(year < century_start, year + 100).otherwise(year)
    return F.make_date(year, month, F.lit(1))


def month_name(d: Column) -> Column:
    """DATE -> ``Jan95``."""
    return F.date_format(d, "MMMyy")


def month_index(d: Column) -> Column:
    """Months since year 0: consecutive months differ by one."""
    return (F.year(d) * 12 + F.month(d) - 1).cast("int")


def comparison_names(kpi_month: Column) -> Column:
    """``kpi_MMMyy`` -> struct(pp, ly, tb) names of the three comparison periods."""
    parts = F.split(kpi_month, "_", 2)
    kpi, d = F.get(parts, 0), parse_month(F.get(parts, 1))
    return F.struct(
        F.concat(kpi, F.lit("_"), month_name(F.add_months(d, -1))).alias("pp"),
        F.concat(kpi, F.lit("_Dec"), F.date_format(F.add_months(d, -12), "yy")).alias("ly"),
        F.concat(kpi, F.lit("_"), month_name(F.add_months(d, -12))).alias("tb"))


def tree_key(name: Column, value: Column) -> Column:
    """A tree level key as printed by the report: ``[name, value]``."""
    return F.concat(F.lit("["), name, F.lit(", "), F.coalesce(value, F.lit("null")), F.lit("]"))


def bind_fields(names: Column, fields: Column) -> Column:
    """An array of names and an array of fields, paired by position: array<(name, value)>.

    A name without a field has the value NULL; fields beyond the names are left out.
    """
    pairs = F.zip_with(names, fields, lambda n, v: F.struct(n.alias("name"), v.alias("value")))
    return F.slice(pairs, F.lit(1), F.size(names))


def filled_names(names: Column) -> Column:
    """Header cells with the blank ones as ``NA_<1-based position>``."""
    return F.transform(names, lambda n, i: F.when(
        (n.isNull()) | (F.trim(F.regexp_replace(n, "\\s", "")) == ""),
        F.concat(F.lit("NA_"), (i + 1).cast("string"))).otherwise(n))
