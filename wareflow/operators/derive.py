"""Typed columns and sequential derived expressions.

``apply_spec`` = bind types -> derive -> drop hidden columns. Everything is a
projection: one narrow stage, no shuffle, fused into whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wareflow.functions.spec import (ColumnSpec, parse_columns, referenced_names,
                                     target_name, to_spark_sql)


def _specs(columns) -> list[ColumnSpec]:
    if columns and isinstance(columns[0], ColumnSpec):
        return list(columns)
    return parse_columns(list(columns))


def bind_types(df: DataFrame, columns, number_type: str = "double",
               on_bad_number: str = "fail") -> DataFrame:
    """Keep the declared columns in declared order with their types.

    String columns are cast to string, number columns to ``number_type``
    (one type per column). Text that is not a number fails the job under ANSI
    casts (``on_bad_number="fail"``) or becomes NULL (``"null"``).
    """
    if on_bad_number not in ("fail", "null"):
        raise ValueError("on_bad_number must be 'fail' or 'null'")
    cols: list[Column] = []
    for spec in _specs(columns):
        c = F.col(f"`{spec.name}`")
        if spec.is_string:
            cols.append(c.cast("string").alias(spec.name))
        elif on_bad_number == "null":
            cols.append(c.try_cast(number_type).alias(spec.name))
        else:
            cols.append(c.cast(number_type).alias(spec.name))
    return df.select(*cols)


def normalize_exprs(exprs) -> list[tuple[str, str]]:
    """``[(":t", "body"), ...]`` -> ``[("t", spark_sql_body), ...]``."""
    return [(target_name(t), to_spark_sql(b)) for t, b in exprs]


def derive(df: DataFrame, exprs) -> DataFrame:
    """Add or replace columns in order; each expression sees earlier targets.

    Consecutive expressions that neither read nor rewrite a target of the same
    batch go into one ``withColumns`` call (one Project); a dependency starts a
    new batch, so a reassigned column is seen by every later expression.
    Catalyst collapses the batches into a single projection afterwards.
    """
    batch: dict[str, Column] = {}
    spelled = {c.lower(): c for c in df.columns}
    for name, _ in normalize_exprs(exprs):
        if spelled.setdefault(name.lower(), name) != name:
            raise ValueError(f"target {name!r} differs only in case from {spelled[name.lower()]!r}")
    for name, body in normalize_exprs(exprs):
        reads = referenced_names(body)
        if name in batch or reads & set(batch):
            df = df.withColumns(batch)
            batch = {}
        batch[name] = F.expr(body)
    if batch:
        df = df.withColumns(batch)
    return df


def drop_hidden(df: DataFrame, columns) -> DataFrame:
    """Drop the columns marked with ``_``."""
    hidden = [s.name for s in _specs(columns) if s.hidden]
    return df.drop(*hidden) if hidden else df


def apply_spec(df: DataFrame, columns, exprs: Sequence = (),
               number_type: str = "double", on_bad_number: str = "fail") -> DataFrame:
    """Typed columns -> derived expressions -> hidden columns dropped."""
    specs = _specs(columns)
    typed = bind_types(df, specs, number_type, on_bad_number)
    return drop_hidden(derive(typed, exprs), specs)
