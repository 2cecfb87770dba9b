"""Registered queries, each with the statement that must give the same rows.

A query takes (spark, folder of the tables) and returns a DataFrame. Its
statement runs on the same tables in another SQL engine; queries that SQL
cannot express have none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
STATEMENTS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            STATEMENTS[name] = sql
        return fn

    return register
