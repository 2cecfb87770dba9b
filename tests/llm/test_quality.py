import random

import numpy as np
import pytest

from newsloom.llm import quality as Q

SCHEMA = "doc_id long, text string, score double, quality string"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(n)).capitalize() + "."


def junk(rng, n):
    kind = rng.randint(0, 2)
    if kind == 0:
        return " ".join([prose(rng, 1)] * n)
    if kind == 1:
        return " ".join(w + "###" for w in prose(rng, n).split())
    return prose(rng, n).upper().replace(" ", "!! ")


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    return [(i, junk(rng, rng.randint(5, 80)) if i % 4 == 0 else prose(rng, rng.randint(5, 80)), 0.0, "x") for i in range(600)]


def test_features_of_odd_texts():
    for data in (b"", b" ", b"\n\n", b"\x00", "é😀".encode(), b"x" * 200_000, b"a b " * 50_000):
        row = Q.features_of(data)
        assert len(row) == len(Q.FEATURES) and np.isfinite(row).all()


def test_tables_add_up(corpus):
    x = np.array([Q.features_of(t.encode()) for _, t, *_ in corpus])
    y = np.array([float(i % 4 != 0) for i, *_ in corpus])
    model = Q.fit_model(x, y)
    for i in range(5):
        raw = model["intercept"]
        for j, (edges, table) in enumerate(zip(model["edges"], model["tables"], strict=True)):
            raw += table[sum(e <= x[i, j] for e in edges)]
        for a, b, ea, eb, table in model["pairs"]:
            raw += table[sum(e <= x[i, a] for e in ea), sum(e <= x[i, b] for e in eb)]
        assert Q.score_rows(model, x[i : i + 1])[0] == pytest.approx(1 / (1 + np.exp(-raw)))


def test_pair_tables_learn_what_single_ones_cannot():
    rng = np.random.default_rng(0)
    x = np.zeros((2000, len(Q.FEATURES)))
    x[:, :2] = rng.random((2000, 2))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = Q.fit_model(x, y)
    assert ((Q.score_rows(model, x) > 0.5) == y).mean() > 0.95


def test_held_out_accuracy(spark, corpus):
    docs = spark.createDataFrame(corpus, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(600) if i % 5], "doc_id long, quality int, toxic int")
    model = Q.train(docs, labels)
    got = {r.doc_id: r.s for r in Q.with_quality(docs, model, "s").select("doc_id", "s").collect()}
    assert np.mean([(got[i] >= Q.THRESHOLD) == (i % 4 != 0) for i in range(0, 600, 5)]) > 0.95
    kept = Q.keep_good(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, s in got.items() if s >= Q.THRESHOLD}


def test_samples_nulls_and_missing_labels(spark, corpus):
    docs = spark.createDataFrame([*corpus, (None, None, 0.0, "x"), (601, None, 0.0, "x"), (602, "", 0.0, "x")], SCHEMA)
    labels = spark.createDataFrame([(i, i % 4 != 0 and 1 or 0) for i in range(600)] + [(None, 1), (1, None), (5000, 1), (3, 1), (3, 1)], "doc_id long, quality int")
    a, b = (Q.score_rows(Q.train(docs.repartition(n), labels.repartition(n), sample=100), np.eye(len(Q.FEATURES))) for n in (1, 7))
    assert (a == b).all()
    scored = {r.doc_id: r.s for r in Q.with_quality(docs, Q.train(docs, labels), "s").collect()}
    assert scored[601] == scored[602] == scored[None] and 0 <= scored[601] <= 1
    even = Q.train(docs, labels.where("false"))
    assert {r.s for r in Q.with_quality(docs, even, "s").collect()} == {0.5}
    assert Q.with_quality(docs.where("false"), even, "s").collect() == []


def test_text_column_with_a_dot(spark):
    docs = spark.createDataFrame([(1, "Some words of a text."), (2, None)], "id long, `t.x` string")
    model = Q.train(docs, spark.createDataFrame([(1, 1), (2, 0)], "id long, quality int"), "id", "t.x")
    assert Q.with_quality(docs, model, text_col="t.x").count() == 2
    assert Q.keep_good(docs, model, 0.0, "t.x").count() == 2
