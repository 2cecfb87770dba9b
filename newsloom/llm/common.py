"""Small helpers the operators of this folder share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.session import shared_dir

# The ASCII white space that the contracts name: space and U+0009 to U+000D.
WHITE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def texts_of(column: pa.Array) -> list[str]:
    """The strings of an Arrow column, null as empty."""
    return [t or "" for t in column.to_pylist()]


def batch(schema: pa.Schema, *columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )


def fresh(df: DataFrame, *taken: str) -> str:
    """A column name that the frame does not use."""
    used = {c.lower() for c in [*df.columns, *taken]}
    n = 0
    while f"_new{n}" in used:
        n += 1
    return f"_new{n}"


def quoted(name: str) -> str:
    """A column name as it must be written to reach a column with dots in its name."""
    return "`" + name.replace("`", "``") + "`"


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns of a frame under the names an operator uses; all others are left behind."""
    return df.select(*[F.col(quoted(source)).alias(name) for name, source in columns.items()])
