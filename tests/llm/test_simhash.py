import random
import re

import numpy as np
import pytest
import xxhash

from newsloom.llm import simhash as S

SCHEMA = "doc_id long, text string, fp string, component_id int"


def slow_print(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \n", "one", "a b c", "a b c d", "A b C d E", "x " * 50, "é Ü ß   k", "t\x0bu\x0cv w x y"])
def test_fingerprint_by_definition(text):
    assert S.fingerprint(text.encode()) % (1 << 64) == slow_print(text)


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_bit_sliced_distances(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**63, 3).astype(np.uint64)
    prints = np.array([base[i % 3] ^ np.uint64(sum(1 << int(b) for b in set(rng.integers(0, 64, i % 12)))) for i in range(333)])
    queries = prints[:5]
    found = S.within(S.planes_of(prints), queries, radius)
    for q, lanes in zip(queries, found, strict=True):
        assert (S._unpacked(lanes, len(prints)) == np.flatnonzero(np.bitwise_count(prints ^ q) <= radius)).all()


def components(prints, radius):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= radius) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_bucket_forest_is_exact():
    rng = np.random.default_rng(1)
    seeds = rng.integers(0, 2**63, 4).astype(np.uint64)
    prints = np.array([seeds[i % 4] ^ np.uint64(sum(1 << int(b) for b in rng.integers(0, 20, 5))) for i in range(300)])
    assert S.bucket_forest(prints, 4).tolist() == components(prints, 4)


@pytest.mark.parametrize("bucket", [1 << 15, 8])
def test_links_find_all_components_also_in_split_buckets(spark, bucket):
    random.seed(3)
    centres = [random.getrandbits(64) for _ in range(6)]
    values = {c ^ sum(1 << b for b in random.sample(range(64), random.randint(0, 5))) for c in centres for _ in range(60)} | {random.getrandbits(64) for _ in range(200)}
    prints = np.array(sorted(values), np.uint64)
    df = spark.createDataFrame([(int(v),) for v in prints.view(np.int64)], "fp long")
    links = S.links_of(df, bucket=bucket).collect()
    at = {int(v): i for i, v in enumerate(prints.view(np.int64))}
    root = S.forest(len(prints), np.array([at[r.a] for r in links]), np.array([at[r.b] for r in links]))
    want = components(prints, 4)
    assert {(a, b) for a, b in zip(root.tolist(), want, strict=True)} == {(a, a) for a in want}


def test_groups_of_rows(spark):
    rng = random.Random(5)
    text = " ".join(rng.choice("abcdefgh") * rng.randint(1, 6) for _ in range(400))
    near = text.rsplit(" ", 1)[0] + " changed"
    rows = [(9, text, "", 1), (4, text, "", 1), (6, near, "", 1), (2, None, "", 1), (3, "", "", 1), (7, "quite another text of some words", "", 1), (None, text, "", 1)]
    assert bin(slow_print(text) ^ slow_print(near)).count("1") <= 4
    got = {(r.doc_id, r.component_id) for r in S.near_groups(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(9, 4), (4, 4), (6, 4), (2, 2), (3, 2), (7, 7), (None, 4)}
    kept = S.drop_near_copies(spark.createDataFrame([*rows, rows[1]], SCHEMA))
    assert kept.columns == ["doc_id", "text", "fp", "component_id"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "4", "7", "None"]


def test_empty_table(spark):
    assert S.near_groups(spark.createDataFrame([], SCHEMA)).collect() == []


def test_masks_need_more_ranges_than_bits(spark):
    with pytest.raises(ValueError):
        S.links_of(spark.createDataFrame([], "fp long"), radius=4, blocks=4)
