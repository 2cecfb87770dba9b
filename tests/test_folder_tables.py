"""Queries over tables that are folders of files, as they are when they are large."""

import pytest

from newsloom.catalog import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def write_documents(spark, folder, data, files):
    rows = [(i, t, "nl", s, len(t or "")) for i, t, s in data]
    spark.createDataFrame(rows, SCHEMA).repartition(files).write.parquet(str(folder / "documents.parquet"))
    # another table beside it, of other columns
    spark.range(3).write.parquet(str(folder / "labels.parquet"))


@pytest.mark.parametrize("files", [1, 3])
def test_streams_read_every_file_of_a_table(spark, tmp_path, files):
    data = [(1, "Het mkb.", "a"), (2, "Een bank.", None), (3, "Het mkb.", "a"), (4, "", "b"), (5, None, "b")]
    write_documents(spark, tmp_path, data, files)
    got = sorted(r.doc_id for r in QUERIES["stream_exact_append"](spark, str(tmp_path)).collect())
    assert got == [1, 2, 4]
    keyed = QUERIES["stream_keyed_append"](spark, str(tmp_path)).collect()
    assert len({r.url for r in keyed}) == len(keyed) == 3
    assert sorted(r.has_source for r in keyed) == [False, True, True]
    assert QUERIES["stream_ingest"](spark, str(tmp_path)).count() == 3


def test_arrays_are_as_many_as_their_length_asks_for(spark, tmp_path):
    from newsloom.catalog import ingest_queries as iq

    data = [(i * 1000, f"titel {i}\ntekst é", f"s{i % 20}") for i in range(300)] + [(None, "geen", "s1"), (None, None, None)]
    write_documents(spark, tmp_path, data, 3)
    iq._json_arrays(spark, str(tmp_path), str(tmp_path / "arrays"))
    assert len(list((tmp_path / "arrays").rglob("*.txt"))) <= 8  # of 300 sources and hundreds of ids
    back = iq.json_dir_scan(spark, str(tmp_path)).collect()
    url = lambda i: None if i is None else f"https://news.example/{i}"
    assert sorted(map(str, ((r.url, r.full_text, r.feed) for r in back))) == sorted(map(str, ((url(i), t, s) for i, t, s in data)))


def test_first_source_of_an_address_leads_through_many_arrays(spark, tmp_path):
    from newsloom.plans import pipelines as pl
    from newsloom.sources import writers

    data = [(f"u{i % 50}", f"s{(i * 7) % 11:02d}", "x" * 40) for i in range(600)]
    df = spark.createDataFrame(data, "url string, feed string, full_text string")
    writers.write_json_arrays(df, str(tmp_path / "arrays"), "url", order=["feed", "url"], array_chars=1000)
    assert len(list((tmp_path / "arrays").glob("*.txt"))) > 20
    merged = {r.url: r.feed for r in pl.merge_articles(spark, str(tmp_path / "arrays"), names="*.txt").collect()}
    assert merged == {u: min(s for v, s, _ in data if v == u) for u in {u for u, _, _ in data}}
