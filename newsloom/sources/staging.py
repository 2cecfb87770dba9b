"""Intermediate tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from newsloom.session import shared_dir


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    Used where an expensive result feeds several branches. Unlike a cached
    table it survives the loss of executors and cuts the lineage.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
