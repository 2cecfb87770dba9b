"""Removal of repeated byte strings against a search of every string."""

import random

import numpy as np
import pytest

from newsloom.llm.repeats import merged_blocks, remove_repeats, repeated_windows, transform_order, heads, turns_of


def expected(rows, depth):
    first = {}
    for i, text in rows:
        if i is not None:
            for p in range(len(text) - depth + 1):
                w = text[p : p + depth]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, text in rows:
        gone = bytearray(len(text))
        if i is not None:
            for p in range(len(text) - depth + 1):
                if first[text[p : p + depth]] < i:
                    gone[p : p + depth] = b"\1" * depth
        out.append((i, len(text), bytes(b for b, g in zip(text, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def rows_of():
    rnd = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "ünder", "x", "the", "of"]
    base = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 60))) for _ in range(30)]
    rows = []
    for i in range(150):
        text = " ".join(rnd.choice(base)[rnd.randint(0, 20) :][: rnd.randint(20, 300)] for _ in range(rnd.randint(0, 4)))
        rows.append((i if rnd.random() < 0.95 else rnd.choice([None, 5, 7]), text))
    return rows + [
        (3, base[3] * 3), (900, "a" * 5000), (901, "a" * 300 + "b" * 60), (902, None), (903, ""), (904, "ab" * 4000),
        (905, "\0" * 100), (906, "\0" * 49 + "a" * 51), (1000, "long " * 30000), (1001, base[0] * 500),
    ]


@pytest.mark.parametrize(
    "options",
    [{}, {"bucket": 3000}, {"largest": 2000}, {"largest": 500, "merged": 20}, {"depth": 7, "gram": 3}, {"gram": 16, "merged": 500}],
)
def test_every_repeat_goes_and_nothing_else(spark, options):
    rows = rows_of()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(((r.doc_id, r.n_bytes, bytes(r.kept)) for r in remove_repeats(docs, **options).collect()), key=repr)
    assert got == expected([(i, (t or "").encode()) for i, t in rows], options.get("depth", 50))


def test_spans_are_maximal_and_name_what_went(spark):
    passage = "0123456789" * 6
    docs = spark.createDataFrame([(1, passage), (2, "x" + passage + "y" + passage)], "doc_id long, text string")
    second = remove_repeats(docs).where("doc_id = 2").first()
    assert second.spans == [1, 61, 62, 122] and bytes(second.kept) == b"xy"


def test_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, mark string, spans string, bucket string, `a.b` int"
    assert remove_repeats(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "q" * 80, "m", "s", "b", 1), (2, "q" * 80, None, None, None, None)]
    got = {r.doc_id: len(r.kept) for r in remove_repeats(spark.createDataFrame(rows, schema)).collect()}
    assert got == {1: 80, 2: 0}


def test_transform_orders_suffixes_with_what_follows_the_end_marks():
    text = np.frombuffer(b"banana", np.uint8).astype(np.uint64) + np.uint64(1)
    symbols = np.concatenate([text, [np.uint64(0)], text[1:], [np.uint64(0)]])
    order = transform_order(heads(symbols))
    whole = [tuple(symbols[i:].tolist()) for i in order]
    assert whole == sorted(whole)


def test_merge_finds_the_windows_of_two_transforms_alike():
    rnd = random.Random(1)
    pieces = ["".join(rnd.choice("ab") for _ in range(rnd.randint(5, 30))).encode() for _ in range(60)]
    docs = [rnd.randint(0, 5) for _ in pieces]
    depth = 5
    first = {}
    for d, p in zip(docs, pieces, strict=True):
        for i in range(len(p) - depth + 1):
            first[p[i : i + depth]] = min(first.get(p[i : i + depth], d), d)
    expect = [first[p[i : i + depth]] < d for d, p in zip(docs, pieces, strict=True) for i in range(len(p) - depth + 1)]
    text, sizes = np.frombuffer(b"".join(pieces), np.uint8), np.array([len(p) for p in pieces])
    for longest in (10, 100, 1 << 14):
        assert repeated_windows(text, sizes, np.array(docs), depth, longest).tolist() == expect


def test_turns_cover_the_depth():
    for rows, candidates in ((10, 5), (1 << 17, 1 << 15), (1 << 22, 1 << 20), (1 << 30, 1 << 29)):
        assert sum(turns_of(50, rows, candidates)) == 50
    none = merged_blocks([], [], [], np.zeros(0, np.int32), np.zeros(0, np.int64))
    assert [len(x) for x in none] == [0, 0]
