"""Grouped nested reports: segment -> selector -> items, and their JSON trees.

A report spec names fields of the rows::

    {"selector":  [(":Bottler", "bottler"), (":Channel", "channel")],
     "dimension": [(":date", "date"), ("LNS", "bottler")],
     "metrics":   [(":score", "score"), (":score_tb", "score_tb")]}

Entries starting with ``:`` are named picks; a dimension entry without ``:``
is a constant the field must equal for the row to count. Fields may also be
given by position (an int) in the row's columns. The segment is the named
dimensions; its label is their names joined by ``_``, or ``overall``.

Specs may name different metrics: their rows then carry the metrics as JSON text,
otherwise as one struct. A report document is one row, so its items are gathered
once they are known to fit: a document whose items take more than ``max_bytes``
of JSON text fails before anything is gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wareflow.functions.columns import tree_key

OVERALL = "overall"


def _field(df: DataFrame, ref) -> str:
    return df.columns[ref] if isinstance(ref, int) else ref


def _named(entries) -> list[tuple[str, object]]:
    return [(n[1:], f) for n, f in entries if n.startswith(":")]


def _constants(entries) -> list[tuple[str, object]]:
    return [(n, f) for n, f in entries if not n.startswith(":")]


def segment_label(spec) -> str:
    names = [n for n, _ in _named(spec.get("dimension", []))]
    return "_".join(names) if names else OVERALL


def match_constants(df: DataFrame, spec) -> DataFrame:
    """Rows whose constant dimension fields equal their constants."""
    cond = F.lit(True)
    for value, ref in _constants(spec.get("dimension", [])):
        cond = cond & (F.col(f"`{_field(df, ref)}`") == F.lit(value))
    return df.where(cond)


def _pairs(df: DataFrame, entries) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("name"),
                              F.col(f"`{_field(df, f)}`").cast("string").alias("value"))
                     for n, f in entries])


def _metrics(rows: DataFrame, spec) -> list[tuple[str, str]]:
    """(name, type) of a spec's metrics."""
    types = dict(rows.dtypes)
    return [(n, types[_field(rows, f)]) for n, f in _named(spec.get("metrics", []))]


def _json(metrics: Column) -> Column:
    """JSON text of a metrics struct; a NULL metric is printed as null."""
    return F.to_json(metrics, {"ignoreNullFields": "false"})


def report_rows(df: DataFrame, specs: Sequence[dict]) -> DataFrame:
    """One row per (spec, matching row): segment, selector (JSON text),
    dims (array<name,value>), metrics.

    ``metrics`` is a struct of the named fields when all specs name the same
    ones, and JSON text (an object) when their shapes differ.
    """
    alike = len({tuple(_metrics(df, spec)) for spec in specs}) == 1
    out = None
    for spec in specs:
        rows = match_constants(df, spec)
        dims = _named(spec.get("dimension", []))
        sel = _named(spec.get("selector", []))
        mets = _named(spec.get("metrics", []))
        selector = F.to_json(F.transform(_pairs(rows, sel),
                                         lambda p: F.array(p["name"], p["value"])))
        metrics = F.struct(*[F.col(f"`{_field(rows, f)}`").alias(n) for n, f in mets])
        part = rows.select(F.lit(segment_label(spec)).alias("segment"),
                           selector.alias("selector"), _pairs(rows, dims).alias("dims"),
                           (metrics if alike else _json(metrics)).alias("metrics"))
        out = part if out is None else out.unionByName(part)
    return out


#: Greatest JSON text of one report document's items.
DOCUMENT_BYTES = 64 << 20


def _text(rows: DataFrame) -> Column:
    """The metrics of each row as JSON text."""
    return F.col("metrics") if dict(rows.dtypes)["metrics"] == "string" else _json(F.col("metrics"))


def require_documents_fit(rows: DataFrame, max_bytes: int) -> None:
    """Fail if the items of one (segment, selector) take more than ``max_bytes``.

    One aggregation, combined map-side: a document of any size costs one row per task.
    """
    size = F.octet_length(_text(rows)) + 1
    sums = rows.groupBy("segment", "selector").agg(F.sum(size).alias("bytes"))
    worst = sums.agg(F.max(F.struct("bytes", "segment", "selector")).alias("w")).first()["w"]
    if worst is not None and worst["bytes"] > max_bytes:
        raise ValueError(f"report document {worst['segment']} {worst['selector']} has {worst['bytes']} bytes "
                         f"of items, more than {max_bytes}")


def report(df: DataFrame, specs: Sequence[dict], max_bytes: int = DOCUMENT_BYTES) -> DataFrame:
    """(segment, selector, items): every spec's rows accumulate per key; items
    are {dims, metrics} structs sorted for a deterministic order."""
    rows = report_rows(df, specs)
    require_documents_fit(rows, max_bytes)
    return (rows.groupBy("segment", "selector")
            .agg(F.array_sort(F.collect_list(F.struct("dims", "metrics"))).alias("items")))


def _quoted(text: Column) -> Column:
    """``text`` as a JSON string: the single element of a printed array."""
    one = F.to_json(F.array(text))
    return F.substring(one, F.lit(2), F.length(one) - 2)


def report_tree(rows: DataFrame, n_dims: int, max_bytes: int = DOCUMENT_BYTES) -> DataFrame:
    """(segment, selector, data): the nested JSON tree of each report.

    One level per dimension, keyed ``[name, value]``; the innermost level
    holds ``items``, the list of metric objects, sorted by their values (by
    their text when specs name different metrics). Values that print alike,
    such as NULL and the text ``null``, share a key.

    The tree grows from its leaves. Raw rows are grouped once, on the whole
    path (segment, selector and every key), so a large document is spread over
    as many tasks as it has leaves; each node is then turned into JSON text
    and only that text goes to the next, shorter grouping.
    """
    require_documents_fit(rows, max_bytes)
    printed = [F.get(F.col("dims"), i) for i in range(n_dims)]
    keys = ["segment", "selector"] + [f"_k{i}" for i in range(n_dims)]
    level = (rows.select("segment", "selector", F.col("metrics").alias("_order"), _text(rows).alias("_text"),
                         *[tree_key(d["name"], d["value"]).alias(f"_k{i}") for i, d in enumerate(printed)])
             .groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_order", "_text"))).alias("_items")))
    node = F.concat(F.lit('{"items":['), F.array_join(F.transform("_items", lambda x: x["_text"]), ","), F.lit("]}"))
    for i in reversed(range(n_dims)):
        entry = F.struct(F.col(f"_k{i}").alias("key"), F.col("_node").alias("node"))
        level = (level.select(*keys[:3 + i], node.alias("_node"))
                 .groupBy(*keys[:2 + i]).agg(F.array_sort(F.collect_list(entry)).alias("_children")))
        node = F.concat(F.lit("{"), F.array_join(F.transform(
            "_children", lambda x: F.concat(_quoted(x["key"]), F.lit(":"), x["node"])), ","), F.lit("}"))
    return level.select("segment", "selector", node.alias("data"))


def report_table(df: DataFrame, specs: Sequence[dict], category: str = "score",
                 max_bytes: int = DOCUMENT_BYTES) -> DataFrame:
    """Rows of the keyed report table: (category, name, selector, data).

    Specs are grouped by their number of named dimensions (one tree shape
    each, whatever their metrics) and the trees unioned.
    """
    by_depth: dict[int, list[dict]] = {}
    for spec in specs:
        by_depth.setdefault(len(_named(spec.get("dimension", []))), []).append(spec)
    out = None
    for depth, group in sorted(by_depth.items()):
        t = report_tree(report_rows(df, group), depth, max_bytes)
        out = t if out is None else out.unionByName(t)
    return out.select(F.lit(category).alias("category"), F.col("segment").alias("name"),
                      "selector", "data")
