"""Blank handling, trimming and fallbacks on string columns."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything a Unicode-aware whitespace test accepts; Java and RE2 agree on it.
SPACE = r"\s\p{Z}\x0B\x1C-\x1F\x85"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nonblank(c: Column | str) -> Column:
    """True when the value holds a visible character; null counts as blank."""
    return F.coalesce(_col(c).rlike(rf"[^{SPACE}]"), F.lit(False))


def is_blank(c: Column | str) -> Column:
    return ~nonblank(c)


def blank_to_empty(c: Column | str) -> Column:
    return F.regexp_replace(F.coalesce(_col(c), F.lit("")), rf"^[{SPACE}]+$", "")


def strip(c: Column | str) -> Column:
    """Trim all whitespace, not only the blank character."""
    return F.regexp_replace(_col(c), rf"^[{SPACE}]+|[{SPACE}]+$", "")


def collapse_ws(c: Column | str, keep_null: bool = False) -> Column:
    """Every run of whitespace becomes one blank and both ends are trimmed."""
    value = _col(c) if keep_null else F.coalesce(_col(c), F.lit(""))
    return F.trim(F.regexp_replace(value, rf"[{SPACE}]+", " "))


def first_nonblank(*cols: Column | str, default: str = "") -> Column:
    return F.coalesce(*[F.when(nonblank(c), strip(c)) for c in cols], F.lit(default))


def raw_text(full_text="full_text", title="title", summary="summary") -> Column:
    """The article body, or title and summary when there is no body."""
    headline = F.concat(F.coalesce(_col(title), F.lit("")), F.lit(" "), F.coalesce(_col(summary), F.lit("")))
    return F.when(nonblank(full_text), _col(full_text)).otherwise(strip(headline))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(False)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions) if conditions else F.lit(True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Name a value once and use it many times inside one expression."""
    return F.transform(F.array(value), body)[0]


def sql_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def interleave(parts: Column, inserts: Column) -> Column:
    """Join n+1 text parts with the n strings that belong between them."""
    pairs = F.zip_with(parts, inserts, lambda p, i: F.concat(p, F.coalesce(i, F.lit(""))))
    return F.array_join(pairs, "")
