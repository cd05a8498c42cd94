"""Connected components against union-find."""

import random

import pytest

from postwave.llm.components import components


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(1, 2)], [(k, k + 1) for k in range(60)], [(0, k) for k in range(1, 80)], [(99, k) for k in range(1, 80)],
    [(random.Random(4).randrange(60), random.Random(k).randrange(60)) for k in range(40)] + [(5, None)],
])
def test_components(spark, edges):
    edges = [e for e in edges if None not in e]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    assert got == {x: find(x) for x in root}
