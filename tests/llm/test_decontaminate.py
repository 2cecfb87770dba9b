import random
import re

from newsloom.llm.decontaminate import contamination, decontaminate

DOCS = "doc_id long, text string, n_words string, items int"
ITEMS = "item_id long, text string"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def by_hand(text, items):
    row, hit, found = words(text), set(), set()
    for item, other in items:
        w = words(other)
        size = min(10, len(w))
        for window in {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else ():
            for i in range(len(row) - size + 1):
                if tuple(row[i : i + size]) == window:
                    hit |= set(range(i, i + size))
                    found.add(str(item))
    return len(row), len(hit), sorted(found)


def test_random_texts_against_plain_search(spark):
    rng = random.Random(2)
    pick = lambda n, k: " ".join(rng.choice(["a", "B", "cé", "9", "x-y", "Ünd", "e"][:k]) for _ in range(n))
    items = [(i, pick(rng.choice([1, 3, 9, 10, 11, 25]), 7)) for i in range(12)] + [(50, None), (51, " ... "), (2, pick(12, 7))]
    docs = [(i, pick(rng.randint(0, 120), 4 + i % 4) + " " + (items[i % 12][1] if i % 3 == 0 else ""), "z", 1) for i in range(60)] + [(99, None, "z", 1)]
    frame, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    for size in (16 << 20, 60):  # one broadcast, and several
        got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in contamination(frame, bench, slice_bytes=size).collect()}
        assert got == {i: by_hand(t, items) for i, t, *_ in docs}


def test_removal_of_documents_and_spans(spark):
    item = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, f"Before, {item.upper()}! After.", "k", 2), (2, "clean text", "k", 2), (3, None, "k", 2)], DOCS)
    bench = spark.createDataFrame([(7, item)], ITEMS)
    assert [(r.doc_id, r.n_words) for r in decontaminate(docs, bench).orderBy("doc_id").collect()] == [(2, "k"), (3, "k")]
    cut = {r.doc_id: r.text for r in decontaminate(docs, bench, remove="spans").collect()}
    assert cut == {1: "Before, ! After.", 2: "clean text", 3: None}


def test_empty_tables(spark):
    none, docs = spark.createDataFrame([], ITEMS), spark.createDataFrame([(1, "a b", "", 0)], DOCS)
    assert [(r.n_words, r.n_hit) for r in contamination(docs, none).collect()] == [(2, 0)]
    assert contamination(spark.createDataFrame([], DOCS), none).collect() == []
