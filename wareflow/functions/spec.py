"""Column-marker specs, expression rewriting and table addresses.

Column marker mini-language: ``[']['_']name``

* a leading ``'`` declares a string column, no mark a number column;
* a ``_`` after it keeps the column usable in expressions but drops it from
  the output.

Expressions are ordered ``(":target", "body")`` pairs. ``:name`` refers to a
column; later pairs see the targets of earlier ones. Bodies are Spark SQL with
two conveniences: ``||`` means logical OR and ``&&`` logical AND (Spark SQL
would read ``||`` as string concatenation and reject ``&&``).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

_SIGIL = re.compile(r":([A-Za-z_][A-Za-z0-9_]*)")


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    is_string: bool
    hidden: bool

    @property
    def marker(self) -> str:
        return ("'" if self.is_string else "") + ("_" if self.hidden else "") + self.name


def parse_column(marker: str) -> ColumnSpec:
    """``"'_pay_date"`` -> ColumnSpec("pay_date", is_string=True, hidden=True)."""
    text = marker.strip()
    is_string = text.startswith("'")
    if is_string:
        text = text[1:]
    hidden = text.startswith("_")
    if hidden:
        text = text[1:]
    if not text:
        raise ValueError(f"empty column name in marker {marker!r}")
    return ColumnSpec(text, is_string, hidden)


def parse_columns(markers: list[str]) -> list[ColumnSpec]:
    """Parse a marker list; reject names that collide ignoring case.

    Spark resolves column names case-insensitively by default, while the
    marker names are case-sensitive keys, so ``a`` and ``A`` cannot coexist.
    """
    specs = [parse_column(m) for m in markers]
    seen: dict[str, str] = {}
    for spec in specs:
        key = spec.name.lower()
        if key in seen:
            raise ValueError(f"column {spec.name!r} collides with {seen[key]!r}")
        seen[key] = spec.name
    return specs


def target_name(target: str) -> str:
    """``":is_discount"`` -> ``"is_discount"``."""
    name = target.strip()
    return name[1:] if name.startswith(":") else name


def _outside_literals(text: str):
    """Yield (is_literal, chunk) pieces; quotes are ' " or ` with backslash escapes."""
    out, i, start, quote = [], 0, 0, None
    while i < len(text):
        ch = text[i]
        if quote:
            if ch == "\\":
                i += 2
                continue
            if ch == quote:
                out.append((True, text[start:i + 1]))
                start, quote = i + 1, None
        elif ch in "'\"`":
            if i > start:
                out.append((False, text[start:i]))
            start, quote = i, ch
        i += 1
    if start < len(text):
        out.append((quote is not None, text[start:]))
    return out


def to_spark_sql(body: str) -> str:
    """Rewrite an expression body to Spark SQL.

    Only outside string literals: ``:name`` -> `` `name` ``, ``||`` -> ``OR``,
    ``&&`` -> ``AND``. Colons elsewhere (literals, map keys) are kept.
    """
    pieces = []
    for is_literal, chunk in _outside_literals(body):
        if not is_literal:
            chunk = _SIGIL.sub(lambda m: f"`{m.group(1)}`", chunk)
            chunk = chunk.replace("||", " OR ").replace("&&", " AND ")
        pieces.append(chunk)
    return "".join(pieces).strip()


def referenced_names(body: str) -> set[str]:
    """Names an expression may read: sigils plus bare identifiers."""
    names: set[str] = set()
    for is_literal, chunk in _outside_literals(body):
        if is_literal:
            if chunk.startswith("`"):
                names.add(chunk.strip("`"))
            continue
        names.update(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", chunk))
    return names


def resolve(root: str, address: str) -> str:
    """Dotted table address to warehouse path: ``db.a.b`` -> ``root/db.db/a/b``."""
    parts = address.lstrip(":").split(".")
    if not parts or not parts[0]:
        raise ValueError(f"bad table address {address!r}")
    return "/".join([root.rstrip("/"), parts[0] + ".db", *parts[1:]])


def fill_header(names: list[str | None]) -> list[str]:
    """Blank header names become ``NA_<1-based position>``."""
    return [n if (n is not None and n.strip() != "") else f"NA_{i}"
            for i, n in enumerate(names, start=1)]


def split_pairs(pairs) -> tuple[list[str], list[int]]:
    """Spec pairs ``[[":name", index], ...]`` -> (names, indexes)."""
    names = [target_name(p[0]) for p in pairs]
    idx = [int(p[1]) for p in pairs]
    return names, idx
