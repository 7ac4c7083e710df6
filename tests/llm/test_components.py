"""Connected components against union-find."""

import random

import pytest

from surveywave.llm.common import Scratch
from surveywave.llm.components import connected_components


def union_find(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(up)}


rng = random.Random(3)
ORDER = rng.sample(range(80), 80)
GRAPHS = {
    "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(150)],
    "shuffled path": list(zip(ORDER, ORDER[1:])),
    "two hubs": [(500, k) for k in range(100)] + [(501, k) for k in range(50, 150)],
    "loops and repeats": [(1, 1), (2, 3), (3, 2), (2, 3)],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_against_union_find(spark, name):
    edges = GRAPHS[name]
    found = connected_components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "t")).collect()
    assert len(found) == len({r.node for r in found})
    assert {r.node: r.component for r in found} == union_find(edges)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long"), Scratch(spark, "t")).count() == 0
