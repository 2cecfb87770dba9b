"""Steps that are costly on every word of a text are done once, or only where they decide."""

import pytest

from pyspark.sql import functions as F

from newsloom.catalog import text_queries as tq
from newsloom.operators import places


@pytest.mark.parametrize("name", ["idf_join", "l2_norm"])
def test_terms_are_made_once(spark, tmp_path, name):
    data = [(1, "Een bank in Aken.", "nl", "a", 17), (2, "Bank en winkel.", "nl", "b", 15), (3, None, "nl", None, 0)]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet"))
    df = getattr(tq, name)(spark, str(tmp_path))
    assert "documents.parquet" not in " ".join(df.inputFiles())  # what is left reads the staged terms
    assert {r.doc_id for r in df.collect()} == {1, 2}


def test_start_of_a_name_agrees_with_its_pattern(spark):
    tokens = ["aken", "Aken", "éire", "Éire", "'t", "'S", "'s-Hertogenbosch", "'s-hertogen", "zoo", "{", "a", "z", "`", "1e", "\U0001d400x", "ǅ", "_A", "", None]
    df = spark.createDataFrame([(t,) for t in tokens], "t string")
    for r in df.select("t", places._starts_name(F.col("t")).alias("got"), F.col("t").rlike(places.STARTS_NAME).alias("said")).collect():
        assert r.got == r.said, r.t
