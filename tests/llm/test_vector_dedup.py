"""Vector links against all pairs."""

import numpy as np
import pytest

from basketflow.llm.vector_dedup import _listed, filters_for, link_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, size int, v string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2, "v") for i, v in rows], SCHEMA).repartition(3)


def brute_force(ids, vectors, cosine=0.9):
    x = np.asarray(vectors, dtype=np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= cosine
    np.fill_diagonal(linked, True)
    reach = np.array(ids)
    while True:
        new = np.array([reach[row].min() for row in linked])
        if (new == reach).all():
            return sorted(zip(ids, linked.sum(axis=1) - 1, reach, np.array(ids) == reach, strict=True))
        reach = new


def clustered(n, dims, seed):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // 12, dims))
    near = centres[rng.integers(0, len(centres), n)] + rng.choice([0.05, 0.3, 0.45], (n, 1)) * rng.standard_normal((n, dims))
    near[: n // 10] = near[0]
    return near


@pytest.mark.parametrize(("dims", "block"), [(16, 1500), (16, 20), (3, 50)])
def test_equals_all_pairs(spark, dims, block):
    vectors = clustered(400, dims, dims + block)
    ids = [int(x) for x in np.random.default_rng(1).permutation(10_000)[: len(vectors)]]
    got = link_vectors(table(spark, zip(ids, vectors, strict=True)), block=block, miss=1e-6).collect()
    assert sorted(map(tuple, got)) == brute_force(ids, vectors)


def test_odd_vectors(spark):
    rows = [(1, None), (2, []), (3, [0, 0]), (4, [1, None]), (5, [float("nan"), 1]), (6, [float("inf"), 1]), (7, [1, 0]), (8, [2, 0]), (9, [1, 0]), (9, [1, 0]), (10, [1, 0, 0]), (None, [1, 0])]
    got = sorted(map(tuple, link_vectors(table(spark, rows)).collect()), key=str)
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 10, None)]
    assert got == sorted([*alone, (7, 2, 7, True), (8, 2, 7, False), (9, 2, 7, False)], key=str)


def test_empty_table(spark):
    assert link_vectors(table(spark, [])).count() == 0


def test_list_decoding_equals_all_directions():
    rng = np.random.default_rng(3)
    first, second = rng.integers(-50, 50, (2, 40, 7)).astype(float)
    rows, filters = _listed(first, second, 60.0)
    wanted = {(r, i * 7 + j) for r in range(40) for i in range(7) for j in range(7) if first[r, i] + second[r, j] >= 60}
    assert set(zip(rows.tolist(), filters.tolist(), strict=True)) == wanted and len(rows) == len(wanted)


def test_recall_target_is_met():
    filters = filters_for(5_000, 64, 0.9)
    rng = np.random.default_rng(5)
    x = rng.standard_normal((500, 64))
    y = rng.standard_normal((500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y = 0.9 * x + np.sqrt(0.19) * y / np.linalg.norm(y, axis=1, keepdims=True)
    total = int(filters.size**2) * len(filters.directions)
    keys = [r * total + f for r, f in map(filters.decode, (x, y))]
    assert len(np.unique(np.intersect1d(*keys) // total)) >= 499
