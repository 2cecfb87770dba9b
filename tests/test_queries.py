"""Every registered query against its statement, on the smallest tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

from newsloom.catalog import QUERIES, STATEMENTS  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables are not here")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    assert got
    if name not in STATEMENTS:
        return
    result = sql.execute(STATEMENTS[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert got == sorted(repr(tuple(row[i] for i in places)) for row in result.fetchall())


def test_every_statement_has_a_query():
    assert set(STATEMENTS) <= set(QUERIES)
