"""Vector codes against plain loops."""

import hashlib
import math
import random

import numpy as np
import pytest

from newsloom.llm.vector_codes import compress, nearest


def expected(rows, parts, entries, rounds):
    kept = [(i, label, [math.floor(1024 * x) for x in v]) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][2]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, _, v in kept]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][2]))[:entries]
    books = [[cut[k][p] for k in first] for p in range(parts)]

    def assign():
        far = [[[sum((a - b) ** 2 for a, b in zip(c[p], e, strict=True)) for e in books[p]] for p in range(parts)] for c in cut]
        return [[f.index(min(f)) for f in row] for row in far], [sum(min(f) for f in row) for row in far]

    for _ in range(rounds):
        codes, _ = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [cut[k][p] for k in range(len(kept)) if codes[k][p] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    codes, errors = assign()
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    totals = {}
    for (_, label, _), e in zip(kept, errors, strict=True):
        totals[label] = totals.get(label, 0) + e
    return sorted(((i, "".join(f"{c:02x}" for c in code), e, totals[label], digest) for (i, label, _), code, e in zip(kept, codes, errors, strict=True)), key=repr)


def vectors(n, dims, scale=0.3):
    rnd = random.Random(3)
    return [(i, [rnd.gauss(0, scale) for _ in range(dims)], rnd.choice([None, 1, 2])) for i in range(n)]


@pytest.mark.parametrize(("n", "dims", "parts", "entries", "rounds"), [(60, 8, 4, 16, 4), (5, 8, 4, 256, 2), (40, 6, 3, 7, 0)])
def test_codes_and_errors(spark, n, dims, parts, entries, rounds):
    rows = vectors(n, dims) + [
        (100, None, 1), (101, [None] * dims, 1), (102, [float("nan")] * dims, 1), (103, [float("inf")] + [0.0] * (dims - 1), 2), (104, [], 1),
        (3, [0.25] * dims, None), (3, [0.25] * dims, None), (None, [-0.5] * dims, 2), (200, [900.0] * dims, 2), (201, [-7000.0] * dims, 2),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = sorted((tuple(r) for r in compress(table, parts=parts, entries=entries, rounds=rounds).collect()), key=repr)
    assert got == expected(rows, parts, entries, rounds)


def test_ties_go_to_the_lower_entry():
    values = np.array([[0, 0], [5, 5]], np.int32)
    found, far = nearest(values, np.array([[1, 0], [0, 1], [-1, 0], [5, 5], [5, 5]]))
    assert found.tolist() == [0, 3] and far.tolist() == [1, 0]


def test_empty_table_clashing_columns_and_faults(spark):
    schema = "vec_id long, embedding array<float>, label int, code string, key string, `l.m` int"
    assert compress(spark.createDataFrame([], schema)).count() == 0
    one = [(1, [0.5] * 8, 3, "c", "k", 1)]
    assert [tuple(r)[:4] for r in compress(spark.createDataFrame(one, schema)).collect()] == [(1, "00000000", 0, 0)]
    with pytest.raises(ValueError, match="components"):
        compress(spark.createDataFrame([(1, [0.5] * 8, 3), (2, [0.5] * 4, 3)], "vec_id long, embedding array<float>, label int"))
    with pytest.raises(Exception, match="too large"):
        compress(spark.createDataFrame([(1, [1e30] * 8, 3)], "vec_id long, embedding array<double>, label int"))
