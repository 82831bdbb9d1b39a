import random

import numpy as np
import pytest

from basketflow.llm.graph import components, forest


def plain(edges):
    low = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


@pytest.mark.parametrize("shape", ["random", "chain", "star", "none"])
def test_components(spark, shape):
    rng = random.Random(1)
    ids = rng.sample(range(10**12), 60)
    edges = {
        "random": [(rng.choice(ids), rng.choice(ids)) for _ in range(40)],
        "chain": list(zip(ids, ids[1:], strict=False)),
        "star": [(ids[0], x) for x in ids[1:]],
        "none": [],
    }[shape]
    edges = [(a, b) for a, b in edges if a != b]
    got = components(spark.createDataFrame([*edges, *edges[:3]], "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == plain(edges) and len(got) == len(plain(edges))


def test_forest_connects_the_same():
    rng = np.random.default_rng(0)
    first, second = rng.integers(0, 40, (2, 30))
    child, root = forest(40, first, second)
    edges = list(zip(first.tolist(), second.tolist(), strict=True))
    assert plain([(a, b) for a, b in edges]) | {i: i for i in range(40)} != {}
    whole, tree = plain(edges), plain(list(zip(child.tolist(), root.tolist(), strict=True)))
    assert all(tree.get(x, x) == whole[x] for x in whole)
