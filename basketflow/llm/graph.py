"""Connected components of a graph whose edges are rows, and forests inside one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.shared import as_table


def forest(n: int, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (child, root) that connect what the given edges connect, among ``n`` points of one task."""
    root = np.arange(n)
    while len(first):
        low = np.minimum(root[first], root[second])
        np.minimum.at(root, root[first], low)
        np.minimum.at(root, root[second], low)
        while (root != root[root]).any():
            root = root[root]
        apart = root[first] != root[second]
        first, second = first[apart], second[apart]
    children = np.flatnonzero(root != np.arange(n))
    return children, root[children]


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node and component (its smallest node) for every node of ``edges`` (a, b: long), by alternating stars.

    Each round hangs larger neighbours on the smallest one (large star), then smaller ones (small star); the rows
    never exceed the edges by more than the nodes. Rounds are tables in the shared folder, so none is recomputed.
    Self-loops and repeated edges do not matter; no edges give no rows.
    """
    own = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    stars = as_table(own, "stars")
    seen = None
    for _ in range(most_rounds):
        stars = as_table(_small_star(_large_star(stars)), "stars")
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"no end after {most_rounds} rounds")
    leaves = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionAll(stars.select("v", "v").distinct())


def _large_star(stars: DataFrame) -> DataFrame:
    both = stars.unionAll(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(stars: DataFrame) -> DataFrame:
    least = stars.groupBy("u").agg(F.min("v").alias("m"))
    moved = stars.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()
