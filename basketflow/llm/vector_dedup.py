"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction of a random product code: each of two blocks of a random rotation of space has its own
directions, and a filter is one of either. A vector passes all filters whose inner product with it exceeds a bound;
list decoding finds them from the two sorted lists of block products without trying every pair of directions.
Vectors that share a filter are compared exactly. Several independent codes bring the chance of missing a link at
the threshold below a target; the bound and the number of codes follow from a simulation of random pairs.

Directions and vectors are rounded to integers before the products, which are then exact: every task finds the
same filters for the same vector.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import arrow_types, ship
from basketflow.llm.graph import components, forest
from basketflow.shared import as_table

SCALE = 1 << 16
#: Filters with at most this many rows are broadcast, more are joined by a shuffle.
BROADCAST_ROWS = 200_000


@dataclass(frozen=True)
class Filters:
    directions: np.ndarray  # codes x blocks x directions x dimensions, integers
    bound: float

    @property
    def size(self) -> int:
        return self.directions.shape[2]

    def decode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and filter numbers of all filters that the unit vectors pass."""
        whole = np.rint(vectors * SCALE)
        rows, filters = [], []
        for code, (first, second) in enumerate(self.directions):
            r, f = _listed(whole @ first.T, whole @ second.T, self.bound)
            rows.append(r)
            filters.append(f + code * self.size * self.size)
        return np.concatenate(rows), np.concatenate(filters)


def _listed(first: np.ndarray, second: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of directions whose products add up to the bound, by descending lists."""
    n, size = first.shape
    order = np.argsort(-second, axis=1, kind="stable")
    falling = np.take_along_axis(second, order, axis=1)
    row, i = np.nonzero(first + falling[:, :1] >= bound)  # other directions have no partner
    most = (falling[row] >= (bound - first[row, i])[:, None]).sum(axis=1)
    at = np.repeat(np.arange(len(row)), most)
    j = np.arange(len(at)) - np.repeat(np.cumsum(most) - most, most)
    return row[at], i[at].astype(np.int64) * size + order[row[at], j]


def filters_for(rows: int, dims: int, cosine: float, miss: float = 1e-4, passed: int = 16, together: int = 500, seed: int = 11) -> Filters:
    """A code fit for ``rows`` vectors: ``passed`` filters a vector and code, about ``together`` vectors a filter.

    Pairs at the threshold are missed with probability ``miss``, those above it less often.
    """
    rng = np.random.default_rng(seed)
    size = min(2048, max(8, math.ceil(math.sqrt(rows * passed / together))))
    half = max(1, dims // 2)

    def directions() -> np.ndarray:
        turned = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
        blocks = (turned[:half], turned[half:] if dims > 1 else turned[:half])
        found = [rng.standard_normal((size, len(b))) for b in blocks]
        found = [x / np.linalg.norm(x, axis=1, keepdims=True) / math.sqrt(2) @ b for x, b in zip(found, blocks, strict=True)]
        return np.rint(np.stack(found) * SCALE)

    one, other = _pairs(rng, 1000, dims, cosine)
    code = directions()
    products = [np.rint(one * SCALE) @ block.T for block in code]
    low, high = -float(SCALE) ** 2 * 2, float(SCALE) ** 2 * 2
    for _ in range(40):
        bound = (low + high) / 2
        many = len(_listed(*products, bound)[0]) > passed * len(one) if bound > -float(SCALE) ** 2 else True
        low, high = (bound, high) if many else (low, bound)
    trial = Filters(code[None], high)
    keys = [row * size * size + f for row, f in map(trial.decode, (one, other))]
    found = len(np.unique(np.intersect1d(*keys) // (size * size))) / len(one)
    codes = math.ceil(math.log(miss) / math.log(max(1 - max(found - 0.03, 0.05), 1e-9)))
    return Filters(np.stack([code, *(directions() for _ in range(codes - 1))]), high)


def _pairs(rng: np.random.Generator, n: int, dims: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    x, y = rng.standard_normal((2, n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    norm = np.linalg.norm(y, axis=1, keepdims=True)
    y = np.where(norm > 1e-12, y / np.maximum(norm, 1e-12), x)
    return x, cosine * x + math.sqrt(1 - cosine**2) * y


def _units(values: pa.Array) -> np.ndarray:
    """Unit vectors in double precision."""
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def _earlier(vectors: np.ndarray, rows: np.ndarray, own_filter: int, filters: Filters) -> np.ndarray:
    """Which rows pass which filters with smaller numbers, of those that several of ``rows`` pass."""
    row, number = filters.decode(vectors[rows])
    row, number = rows[row[number < own_filter]], number[number < own_filter]
    _, column, shared = np.unique(number, return_inverse=True, return_counts=True)
    kept = shared[column] > 1
    _, column = np.unique(column[kept], return_inverse=True)
    member = np.zeros((len(vectors), int(column.max(initial=-1)) + 1), dtype=np.float32)
    member[row[kept], column] = 1
    return member


def _linked(ids: np.ndarray, sizes: np.ndarray, vectors: np.ndarray, left: np.ndarray, right: np.ndarray | None, own_filter: int, filters: Filters, cosine: float):
    """Links between ``left`` and ``right`` rows (or within ``left``) whose first common filter is this one."""
    rows = left if right is None else right
    links, none = np.zeros(len(ids), dtype=np.int64), np.zeros((2, 0), dtype=np.int64)

    def close(part: np.ndarray) -> np.ndarray:
        found = vectors[part] @ vectors[rows].T >= cosine
        return found & (ids[part][:, None] < ids[rows][None, :]) if right is None else found

    parts = [left[begin : begin + 256] for begin in range(0, len(left), 256)]
    parts = [part for part in parts if close(part).any()]
    if not parts:
        return links, *none
    met = np.zeros(len(ids), dtype=bool)
    for part in parts:
        found = close(part)
        met[part] |= found.any(axis=1)
        met[rows] |= found.any(axis=0)
    member = _earlier(vectors, np.flatnonzero(met), own_filter, filters)
    edges = []
    for part in parts:
        a, b = np.nonzero(close(part) & (member[part] @ member[rows].T == 0))
        a, b = part[a], rows[b]
        links += np.bincount(a, sizes[b], len(ids)).astype(np.int64) + np.bincount(b, sizes[a], len(ids)).astype(np.int64)
        edges.append(np.stack(forest(len(ids), a, b)))
    edges = np.concatenate(edges, axis=1)
    return links, *forest(len(ids), *edges)


def link_vectors(vectors: DataFrame, cosine: float = 0.9, miss: float = 1e-4, block: int = 1500, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id and kept for every vector, linked at ``cosine`` or more.

    n_links counts other vectors linked directly, component_id is the smallest id reachable. Equal vectors are
    compared once for all their rows. Vectors that are null, empty, zero or hold null or non-finite parts, and rows
    with a null id, link with nothing: their component is their own id. A row that repeats id and vector counts once;
    vectors of different length never link. Two links at the threshold are missed with probability ``miss``.
    """
    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(kind).alias("v"))
    usable = (
        F.coalesce(F.size("v") > 0, F.lit(False))
        & F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))
        & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
        & F.col("vec_id").isNotNull()
    )
    rows = as_table(rows.withColumn("v", F.when(usable, F.col("v"))), "vectors")
    good = rows.where("v is not null").distinct()
    classes = as_table(good.groupBy("v").agg(F.min("vec_id").alias("class"), F.count("*").alias("size")), "classes")
    found = [_links(classes.where(F.size("v") == dims), n, dims, cosine, miss, block) for dims, n in _lengths(classes)]
    if found:
        links = found[0]
        for more in found[1:]:
            links = links.unionAll(more)
        links = as_table(links, "links")
    else:
        links = rows.sparkSession.createDataFrame([], "a long, b long, links long")
    grouped = components(links.where("b is not null").select("a", "b"))
    totals = links.where("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    known = (
        classes.join(totals, "class", "left")
        .join(grouped.withColumnRenamed("node", "class"), "class", "left")
        .select("v", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "class").alias("component_id"))
    )
    linked = good.join(known, "v").select("vec_id", "n_links", "component_id")
    alone = rows.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _lengths(classes: DataFrame) -> list[tuple[int, int]]:
    """Vector lengths and how many classes have them; a table holds few lengths."""
    counts = classes.groupBy(F.size("v").alias("dims")).count().collect()
    return sorted((r["dims"], r["count"]) for r in counts)


def _links(classes: DataFrame, n: int, dims: int, cosine: float, miss: float, block: int) -> DataFrame:
    spark = classes.sparkSession
    ship(spark)
    filters = spark.sparkContext.broadcast(filters_for(n, dims, cosine, miss))  # a code of fixed size

    def assign(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 2000):
                part = batch.slice(begin, 2000)
                row, number = filters.value.decode(_units(part.column(0)))
                taken = part.select(["class", "size", "v"]).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(number), *taken.columns], names=["filter", "class", "size", "v"])

    kind = classes.schema["v"].dataType.simpleString()
    passed = classes.select("v", "class", "size").mapInArrow(assign, f"filter long, class long, size long, v {kind}")
    narrow = classes.select("v", "class", "size").mapInArrow(
        lambda batches: (b.select(["filter"]) for b in assign(batches)), "filter long"
    )
    large = as_table(
        narrow.groupBy("filter").count().where(F.col("count") > block).select("filter", F.ceil(F.col("count") / block).cast("int").alias("blocks")), "large"
    )
    if large.count() <= BROADCAST_ROWS:
        large = F.broadcast(large)
    placed = (
        passed.join(large, "filter", "left")
        .withColumn("own", F.pmod(F.xxhash64("class"), F.coalesce("blocks", F.lit(1))).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
        .select("filter", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "class", "size", "v")
    )
    schema = arrow_types("a long, b long, links long")

    def compare(key, table):
        number, low, high = (k.as_py() for k in key)
        if table.num_rows < 2:
            return schema.empty_table()
        ids, sizes = table["class"].to_numpy(), table["size"].to_numpy()
        own = table["own"].to_numpy()
        left, right = np.flatnonzero(own == low), None if low == high else np.flatnonzero(own == high)
        links, child, root = _linked(ids, sizes, _units(table["v"].combine_chunks()), left, right, number, filters.value, cosine)
        has = np.flatnonzero(links)
        return pa.Table.from_arrays(
            [
                pa.array(np.concatenate([ids[has], ids[child]])),
                pa.concat_arrays([pa.nulls(len(has), pa.int64()), pa.array(ids[root])]),
                pa.array(np.concatenate([links[has], np.zeros(len(child), dtype=np.int64)])),
            ],
            schema=schema,
        )

    return placed.groupBy("filter", "low", "high").applyInArrow(compare, "a long, b long, links long")

