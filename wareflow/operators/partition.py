"""``prt_path``: the partition path carried as the first data column.

``prt_path`` is text such as ``p_date=2016-10-01/p_code=7``. It is written as
an ordinary column and also names the output directory; the directory levels
are derived copies parsed back out of it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRT_PATH = "prt_path"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def prt_path_expr(spec) -> Column:
    """``[(name, column), ...]`` -> ``name=value/name=value`` (NULL -> empty)."""
    parts = []
    for name, col in spec:
        parts.append(F.concat(F.lit(f"{name}="),
                              F.coalesce(_as_col(col).cast("string"), F.lit(""))))
    return F.concat_ws("/", *parts)


def with_prt_path(df: DataFrame, spec) -> DataFrame:
    """Put ``prt_path`` first, built from ``spec``; other columns keep their order."""
    return df.select(prt_path_expr(spec).alias(PRT_PATH),
                     *[F.col(f"`{c}`") for c in df.columns if c != PRT_PATH])


def parse_prt_path(df: DataFrame, names: list[str], column: str = PRT_PATH) -> DataFrame:
    """Append one string column per partition level named in ``names`` (in path order).

    A level's value reaches to the next named level, so it may hold ``/`` and
    ``=``; only a value that spells ``/<later level>=`` itself is cut there. A
    level that the path lacks is NULL. Where the source columns are at hand,
    use :func:`with_levels`, which parses nothing.
    """
    path = F.col(f"`{column}`")

    def level(i: int) -> Column:
        later = "".join(f"|/{re.escape(n)}=" for n in names[i + 1:])
        pattern = f"(?s)(?:^|/){re.escape(names[i])}=(.*?)(?:\\z{later})"
        return F.when(path.rlike(pattern), F.regexp_extract(path, pattern, 1))

    return df.withColumns({n: level(i) for i, n in enumerate(names)})


def with_levels(df: DataFrame, spec) -> DataFrame:
    """``with_prt_path`` plus the level columns, copied from ``spec``'s columns (NULL -> empty)."""
    levels = {n: F.coalesce(_as_col(c).cast("string"), F.lit("")) for n, c in spec}
    taken = {PRT_PATH, *(n.lower() for n in levels)}
    return df.select(prt_path_expr(spec).alias(PRT_PATH),
                     *[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken],
                     *[c.alias(n) for n, c in levels.items()])


def names_of(column: str = PRT_PATH) -> Column:
    """The level names that one path spells, as an array (empty for a blank path)."""
    steps = F.filter(F.split(F.coalesce(F.col(f"`{column}`"), F.lit("")), "/"),
                     lambda s: s.contains("="))
    return F.transform(steps, lambda s: F.split(s, "=", 2)[0])


def level_names(df: DataFrame, column: str = PRT_PATH) -> list[list[str]]:
    """The distinct lists of level names that ``column`` spells, longest first ([] for blank paths).

    They are the folders of the table's layouts: the driver gets their names alone.
    """
    found = df.select(names_of(column).alias("names")).distinct().collect()
    return sorted((list(r["names"]) for r in found), key=lambda x: (-len(x), x))
