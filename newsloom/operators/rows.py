"""Arrays to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_rows(df: DataFrame, array: Column | str, name: str, keep: list[Column | str] | None = None,
                 pos: str | None = None) -> DataFrame:
    """One row per array element; null elements and empty arrays give none.

    Built on the outer form on purpose. For the inner one Spark adds a filter
    on the size of the array below the generator, which computes the array,
    and whatever text work it comes from, a second and third time.
    """
    kept = list(keep or [])
    if pos is None:
        rows = df.select(*kept, F.explode_outer(array).alias(name))
    else:
        rows = df.select(*kept, F.posexplode_outer(array).alias(pos, name))
    return rows.where(F.col(name).isNotNull())
