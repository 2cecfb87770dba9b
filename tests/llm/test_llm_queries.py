"""The registered queries against their statements, on the smallest tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

from newsloom.llm.queries import QUERIES, STATEMENTS  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables are not here")


def counted(folder, name):
    return duckdb.sql(f"SELECT count(*) FROM '{folder}/{name}.parquet'").fetchall()[0][0]


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_statement(spark, name):
    connection = duckdb.connect()
    for table in "documents pages benchmark labels conversations embeddings".split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    result = connection.execute(STATEMENTS[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert got and got == sorted(repr(tuple(row[i] for i in places)) for row in result.fetchall())


@pytest.mark.parametrize(
    ("name", "table"),
    [("op1_quality_classifier", "documents"), ("op3_mix_sources", "documents"), ("op5_token_files", "documents"),
     ("op6_simhash_dedup", "documents"), ("op8_lm_score", "documents"), ("op9_html_text", "pages")],
)
def test_a_row_for_every_row(spark, name, table):
    assert QUERIES[name](spark, FOLDER).count() == counted(FOLDER, table)
