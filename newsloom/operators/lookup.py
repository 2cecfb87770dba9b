"""Joins against dimension tables, with the broadcast decided by measured size.

A dimension is broadcast only after a bounded probe shows that it fits. When
it does not, the join shuffles with a salted key: the big side spreads each
key over ``salts`` tasks and the dimension is repeated once per salt, so a key
that holds a third of the rows is not one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
LITERAL_VALUES = 20_000
SALTS = 32


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure at most ``max_rows + 1`` rows; more rows or bytes means no."""
    width = reduce(
        lambda a, b: a + b,
        [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + F.lit(8) for c in df.columns],
    )
    row = (
        df.limit(max_rows + 1)
        .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes"))
        .first()
    )
    return row["n"] <= max_rows and row["bytes"] <= max_bytes


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    how: str = "inner",
    spread_by: list[str] | None = None,
    max_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
    fits: bool | None = None,
) -> DataFrame:
    """Join rows to a dimension (inner, left, left_semi or left_anti).

    The dimension is measured here unless ``fits`` says what a measurement of
    it, or of a larger table with its rows, has found.

    ``spread_by`` names columns that differ between rows sharing a key; they
    choose the salt, so a retried task makes the same choice again.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a dimension cannot be joined with how={how!r}")
    keys = [on] if isinstance(on, str) else list(on)
    if fits_broadcast(right, max_rows) if fits is None else fits:
        return left.join(F.broadcast(right), keys, how)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in (spread_by or left.columns)]), F.lit(salts)).cast("int")
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.withColumn("_salt", salt).join(copies, [*keys, "_salt"], how).drop("_salt")


def collect_bounded(df: DataFrame, column: str, max_values: int = LITERAL_VALUES) -> list[str] | None:
    """Values of a column when there are at most ``max_values``, else None."""
    rows = df.select(column).limit(max_values + 1).collect()
    return None if len(rows) > max_values else [r[0] for r in rows]


def collect_table(df: DataFrame, key: str, value: str, max_values: int = LITERAL_VALUES) -> dict | None:
    """Values by key when there are at most ``max_values`` rows, else None; rows without a key are left out."""
    rows = df.select(key, value).limit(max_values + 1).collect()
    return None if len(rows) > max_values else {r[0]: r[1] for r in rows if r[0] is not None}


def member_of(value: Column, members: list[str]) -> Column:
    """Hash-set membership; usable inside array lambdas."""
    return value.isin(members) if members else F.lit(False)
