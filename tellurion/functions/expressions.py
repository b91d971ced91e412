"""Expressions that users give as SQL strings or columns, and keys made from them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(x: str | Column) -> Column:
    return F.expr(x) if isinstance(x, str) else x


def holds(cond: str | Column) -> Column:
    """True where the condition is true; a null result does not match."""
    return F.coalesce(column(cond).cast("boolean"), F.lit(False))


def attributes(attrs: Mapping[str, str | Column]) -> Column:
    """A map of text values in the order of their names; entries whose expression is null are left out."""
    if not attrs:
        return F.expr("cast(map() as map<string,string>)")
    pairs = [x for k in sorted(attrs) for x in (F.lit(k), column(attrs[k]).cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def canonical(m: Column) -> Column:
    """One text for equal maps, whatever the order of their entries."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m))))


#: Where \b stands in a pattern: it holds between ASCII word characters and the rest, as in engines with ASCII classes.
ASCII_BOUNDARY = r"(?:(?<=[0-9A-Za-z_])(?![0-9A-Za-z_])|(?<![0-9A-Za-z_])(?=[0-9A-Za-z_]))"


def java_pattern(pattern: str) -> str:
    """A pattern with ASCII word boundaries in Java's syntax; backslashes before a backslash are left alone."""
    out, i = "", 0
    while i < len(pattern):
        two = pattern[i : i + 2]
        if len(two) == 2 and two[0] == "\\":
            out += ASCII_BOUNDARY if two == "\\b" else two
            i += 2
        else:
            out += pattern[i]
            i += 1
    return out
