import os

import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline as P  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_order():
    assert [n for n, _ in P.STAGES] == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "mix_to_weights", "token_files"]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables are not here")
def test_stages_over_the_smallest_tables(spark):
    from newsloom.llm.decontaminate import contamination
    from newsloom.llm.simhash import near_groups

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = []
    for name, step in P.STAGES[:-1]:
        docs = P.stage(step(spark, docs, FOLDER), name)
        assert docs.columns == COLUMNS
        kept.append({r.doc_id for r in docs.select("doc_id").distinct().collect()})
    first, second, third, fourth = kept
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in first for i in good) >= 0.95 * len(good) and sum(i in first for i, q in labels.items() if q == 0) <= 2
    all_docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    groups = near_groups(all_docs.where(all_docs.doc_id.isin(sorted(first)))).collect()
    assert second == {r.component_id for r in groups}
    hit = {r.doc_id for r in contamination(all_docs, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).where("n_hit > 0").collect()}
    assert third == second - hit and fourth == third
    last = P.write_token_files(spark, docs, FOLDER)
    assert last.count() == docs.count()


def test_empty_and_odd_documents(spark, tmp_path):
    docs = spark.createDataFrame([(1, None, None, None, 0), (None, "", "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    none = docs.where("false")
    none.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []
    for _, step in P.STAGES:
        assert isinstance(step(spark, docs, str(tmp_path)).collect(), list)
