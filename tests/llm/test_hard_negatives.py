"""Strassen's products against plain ones, and mining against a version that looks at every row in turn."""

import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.llm import hard_negatives as h

VECTORS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        # names that are used inside must not get in the way
        T.StructField("v", T.StringType()),
        T.StructField("score", T.IntegerType()),
        T.StructField("windows", T.IntegerType()),
        T.StructField("place", T.IntegerType()),
    ]
)


@pytest.fixture(scope="module")
def vectors(spark):
    return lambda rows: spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], VECTORS).repartition(3)


def brute_force(rows, anchor, positives=5, negatives=3, low=50, high=95):
    """Rows with ids that do not repeat."""
    usable = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    found = Counter()
    for a, v, own in usable:
        if not anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), b, other) for b, w, other in usable if b != a)
        for s, p, _ in [x for x in scored if x[2] == own][:positives]:
            inside = [(-t, b) for t, b, other in scored if other != own and low * -s <= 100 * -t <= high * -s]
            found.update((a, p, k, b, -s, t) for k, (t, b) in enumerate(inside[:negatives], 1))
    return found


def rows_of(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(tuple(r) for r in df.collect())


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 40), st.integers(0, 40), st.integers(0, 40), st.integers(1, 9), st.sampled_from([9, 2**30, 2**63 - 1]), st.integers(0, 99))
def test_strassen_is_the_product(m, d, n, leaf, bound, seed):
    """Any shape, any size of numbers: exact modulo 2**64."""
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-bound, bound, (m, d)), rng.integers(-bound, bound, (d, n))
    assert (h.strassen(a, b, leaf) == a @ b).all()


def test_best_takes_the_first_of_equals():
    scores = np.array([[3, 9, 9, h._NONE], [h._NONE] * 4, [1, 1, 1, 1]])
    rows, columns, values = h.best(scores, 3)
    assert sorted(zip(rows.tolist(), columns.tolist(), values.tolist(), strict=True)) == [(0, 0, 3), (0, 1, 9), (0, 2, 9), (2, 0, 1), (2, 1, 1), (2, 2, 1)]


@pytest.mark.parametrize("few", [True, False])
def test_mining_equals_brute_force(vectors, monkeypatch, few):
    """Many ties, a label with a third of the rows, tiles and blocks of a few rows."""
    if few:
        monkeypatch.setattr(h, "NUMBERS_A_BLOCK", 60)
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.integers(0, 3, 6) / 4], int(label)) for i, label in enumerate(rng.choice(5, 300, p=[0.4, 0.3, 0.1, 0.1, 0.1]))]
    found = rows_of(h.mine(vectors(rows), F.col("vec_id") % 20 == 0))
    assert found == brute_force(rows, lambda i: i % 20 == 0) and len(found) > 100


def test_other_bounds(vectors):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.random(4)], i % 3) for i in range(80)]
    found = rows_of(h.mine(vectors(rows), F.col("vec_id") < 7, positives=2, negatives=4, low=80, high=100))
    assert found == brute_force(rows, lambda i: i < 7, 2, 4, 80, 100) and found


def test_odd_rows(vectors):
    """Nulls, values that are not finite, no components, other lengths, negative and zero scores."""
    one = [0.5, 0.5, 0.25]
    rows = [
        (0, one, 1), (1, one, 1), (2, [0.5, 0.25], 2), (3, [], 2), (4, None, 2), (5, [None, 1.0], 2), (6, [float("nan")], 2),
        (7, [float("inf")], 2), (8, one, None), (None, one, 2), (9, [0.5, 0.25, 0.125, 9.0], 3), (10, [-0.5, -1.0, 0.0], 1),
        (20, [-1.0], 2), (30, [0.0], 3), (40, [3.0e30, 1.0], 4), (50, [0.25, 0.25, 0.25], 2),
    ]
    small = [r for r in rows if r[0] != 40]
    found = rows_of(h.mine(vectors(small), F.col("vec_id") % 10 == 0))
    assert found == brute_force(small, lambda i: i % 10 == 0) and found
    h.mine(vectors(rows), F.col("vec_id") % 10 == 0).collect()  # components beyond a long: no failure


def test_repeated_rows(vectors):
    """Copies count each as rows; a row with the anchor's id is no other row."""
    rows = [(0, [1.0], 1), (0, [1.0], 1), (3, [1.0], 1), (3, [1.0], 1), (4, [0.75], 2), (4, [0.75], 2), (5, [0.75], 2), (6, [0.5], 3)]
    found = rows_of(h.mine(vectors(rows), F.col("vec_id") == 0))
    assert found == Counter({(0, 3, 1, 4, 65536, 49152): 1, (0, 3, 2, 4, 65536, 49152): 1, (0, 3, 3, 5, 65536, 49152): 1})


def test_empty_tables(vectors):
    rows = [(1, [1.0], 1), (2, [1.0], 2)]
    assert rows_of(h.mine(vectors(rows).where("vec_id > 2"), F.col("vec_id") == 1)) == {}
    assert rows_of(h.mine(vectors(rows), F.col("vec_id") == 9)) == {}
    assert rows_of(h.mine(vectors(rows), F.col("vec_id") == 1)) == {}
