"""Importance resampling against a count in plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from newsloom.llm.importance import drawn_documents, resample, run_buckets

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features_of(text, longest, buckets):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return words, [zlib.crc32(" ".join(words[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def expected(docs, target, longest, buckets, least, percent, seed):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features_of(text, longest, buckets)[1])
    for _, text in target:
        t.update(features_of(text, longest, buckets)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    rows = []
    for i, text in docs:
        words, found = features_of(text, longest, buckets)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in found)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = {id(r): k for k, r in enumerate(able[: len(able) * percent // 100], 1)}
    return sorted([(i, f, w, sc, drawn.get(id(r))) for r in rows for i, _, f, w, sc in [r]], key=repr)


DOCS = [(i, " ".join(f"w{(i * j) % 23}" for j in range(i % 40)) + ("  Ünd,Äpfel-İx  " if i % 3 else "")) for i in range(200)] + [
    (None, "Some WORDS without_a name " * 9), (500, None), (501, ""), (502, "\n\n--\n"), (503, "long " * 300_000), (504, "a\nb\x0bc\x00d " * 10),
    (7, "a repeated identifier " * 10),
]
TARGET = [(1, "w1 w2 w3 W4 apples"), (2, None), (3, "long a b c d")]


@pytest.mark.parametrize("options", [{}, {"longest": 3, "buckets": 97, "percent": 60}, {"least_words": 0, "percent": 100, "seed": 7}])
def test_weights_scores_and_ranks(spark, options):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(4)
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    got = sorted((tuple(r) for r in resample(docs, target, **options).collect()), key=repr)
    asked = {"longest": 1, "buckets": 10_000, "least_words": 20, "percent": 10, "seed": 2024} | options
    assert got == expected(DOCS, TARGET, asked["longest"], asked["buckets"], asked["least_words"], asked["percent"], asked["seed"])


def test_empty_tables_and_clashing_columns(spark):
    schema = "doc_id long, text string, score string, rank string, buckets string, `x.y` int"
    target = spark.createDataFrame([], "item_id long, text string")
    assert resample(spark.createDataFrame([], schema), target).count() == 0
    rows = [(i, "one two three " * 9, "s", "r", "b", 1) for i in range(20)]
    docs = spark.createDataFrame(rows, schema)
    assert sorted(r["rank"] for r in resample(docs, target).collect() if r["rank"]) == [1, 2]
    kept = drawn_documents(docs, target)
    assert kept.columns == docs.columns and kept.count() == 2


def test_runs_of_texts_do_not_touch():
    codes, counts, words = run_buckets([b"a b", b"", b"c"], 2, 1 << 32)
    assert counts.tolist() == [3, 0, 1] and words.tolist() == [2, 0, 1]
    assert codes.tolist() == [zlib.crc32(x) for x in (b"a", b"b", b"a b", b"c")]
