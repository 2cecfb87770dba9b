import random

import pytest

from newsloom.llm.components import connected


def by_hand(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {(x, find(x)) for x in list(root)}


RNG = random.Random(11)
SHAPES = {
    "chain": [(i, i + 1) for i in range(60)],
    "star": [(500, i) for i in range(100)],
    "random": [(RNG.randint(-300, 300), RNG.randint(-300, 300)) for _ in range(250)],
    "repeated": [(1, 2), (2, 1), (1, 2), (-(2**63), 2**63 - 1), (7, 2**63 - 1)],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_roots_are_the_smallest_reachable(spark, shape):
    links = SHAPES[shape]
    found = connected(spark.createDataFrame(links, "a long, b long")).collect()
    assert {(r.node, r.root) for r in found} == by_hand([x for x in links if x[0] != x[1]])
    assert len(found) == len({r.node for r in found})


def test_no_links(spark):
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []
