"""Hard negatives for anchor vectors: integer inner products by Strassen's recursion, kept in small mergeable heaps.

Vectors become integers. Anchors are sent to the tasks in blocks of bounded size, and each task multiplies its rows with
a block tile by tile: seven half-size products instead of eight, down to small tiles, zeros where a side is odd. Sums
are exact in 64 bits. The first pass keeps the best rows of each anchor's own label, which are its positives; the second
keeps, of the rows with other labels, the best in each positive's window of scores. A task hands on a few rows for each
anchor or window, and those of all tasks are merged by rank.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketflow.llm.common import arrow_types, ship
from basketflow.shared import as_table, new_path

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A negative's score is between these hundredths of the positive's.
LOW, HIGH = 50, 95
#: Numbers in a block of anchors that is broadcast (8 bytes each), and rows of a tile on either side.
NUMBERS_A_BLOCK = 2_000_000
ANCHOR_TILE, ROW_TILE = 256, 2048
#: Products with a side this short are not split further.
LEAF = 32
#: Below it every partial sum of a product is exact in a double, so leaves may go through the faster routine.
_EXACT = 2.0**53
_NONE = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Product of two int64 matrices, modulo 2**64; sides of odd length are padded with zeros at each level."""
    (m, d), n = a.shape, b.shape[1]
    if min(m, d, n) <= leaf:
        return _leaf(a, b)
    if m % 2 or d % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, d % 2)))
        b = np.pad(b, ((0, d % 2), (0, n % 2)))
    i, k, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :k], a[:i, k:], a[i:, :k], a[i:, k:]
    b11, b12, b21, b22 = b[:k, :j], b[:k, j:], b[k:, :j], b[k:, j:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    product = np.empty((2 * i, 2 * j), dtype=np.int64)
    product[:i, :j] = p1 + p4 - p5 + p7
    product[:i, j:] = p3 + p5
    product[i:, :j] = p2 + p4
    product[i:, j:] = p1 - p2 + p3 + p6
    return product[:m, :n]


def _leaf(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if not a.size or not b.size:
        return np.zeros((a.shape[0], b.shape[1]), dtype=np.int64)
    x, y = a.astype(np.float64), b.astype(np.float64)
    if float(np.abs(x).max()) * float(np.abs(y).max()) * a.shape[1] < _EXACT:
        return (x @ y).astype(np.int64)
    return a @ b


def best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and value of the ``k`` largest entries of each row, the first column among equals; the scores are used up."""
    found = []
    rows = np.arange(len(scores))
    for _ in range(min(k, scores.shape[1])):
        at = scores.argmax(axis=1)
        value = scores[rows, at]
        has = value != _NONE
        found.append((rows[has], at[has], value[has]))
        scores[rows, at] = _NONE
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (rows[:0],) * 3


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label and the integer vector of the rows that take part."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("int").alias("label"),
        # floor() of a double is a long, at its bounds for values beyond them
        F.transform(vector_col, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double"))).alias("v"),
    )


class _Block:
    """Some anchors as a matrix, and the windows of scores of each: bounds by place, and what the place stands for."""

    def __init__(self, table: pa.Table):
        self.ids = table["vec_id"].to_numpy()
        self.labels = table["label"].to_numpy()
        self.matrix = _matrix(table["v"].combine_chunks())
        if "windows" in table.column_names:
            lists = table["windows"].combine_chunks()
            sizes = np.diff(lists.offsets.to_numpy())
            has = np.arange(sizes.max(initial=0)) < sizes[:, None]
            self.low, self.high = np.ones(has.shape, np.int64), np.zeros(has.shape, np.int64)  # no score is in it
            self.positive, self.score = np.zeros(has.shape, np.int64), np.zeros(has.shape, np.int64)
            fields = zip(("low", "high", "positive_id", "score"), (self.low, self.high, self.positive, self.score), strict=True)
            for name, into in fields:
                into[has] = lists.flatten().field(name).to_numpy()


def _matrix(lists: pa.ListArray, width: int = 0) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    wide = max(width, int(sizes.max(initial=0)))
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == wide).all():
        return values.reshape(len(lists), wide)
    out = np.zeros((len(lists), wide), dtype=np.int64)
    out[np.arange(wide) < sizes[:, None]] = values
    return out


def _scored(batches: Iterator[pa.RecordBatch], block: _Block) -> Iterator[tuple[np.ndarray, np.ndarray, slice, np.ndarray]]:
    """ids and labels of a tile of rows in order of id, which anchors, and their scores."""
    for batch in batches:
        for begin in range(0, batch.num_rows, ROW_TILE):
            tile = batch.slice(begin, ROW_TILE)
            ids, labels = tile.column(0).to_numpy(), tile.column(1).to_numpy()
            order = np.argsort(ids, kind="stable")
            rows = _matrix(tile.column(2), block.matrix.shape[1])[order]
            anchors = block.matrix
            if rows.shape[1] > anchors.shape[1]:
                anchors = np.pad(anchors, ((0, 0), (0, rows.shape[1] - anchors.shape[1])))
            turned = np.ascontiguousarray(rows.T)
            for first in range(0, len(anchors), ANCHOR_TILE):
                part = slice(first, first + ANCHOR_TILE)
                yield ids[order], labels[order], part, strassen(anchors[part], turned)


class _Heaps:
    """The best few of each key, from parts that come one by one."""

    def __init__(self, keep: int):
        self._keep, self._parts, self._size = keep, [], 0

    def push(self, keys: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        self._parts.append((keys, ids, scores))
        self._size += len(keys)
        if self._size > 1_000_000:
            self._merge()

    def _merge(self) -> None:
        keys, ids, scores = (np.concatenate(x) for x in zip(*self._parts, strict=True))
        order = np.lexsort((ids, ~scores, keys))  # ~x falls as x rises, without overflow
        keys, ids, scores = keys[order], ids[order], scores[order]
        begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        place = np.arange(len(keys)) - np.repeat(begins, np.diff(np.append(begins, len(keys))))
        stay = place < self._keep
        self._parts, self._size = [(keys[stay], ids[stay], scores[stay])], int(stay.sum())

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self._parts:
            return (np.zeros(0, np.int64),) * 3
        self._merge()
        return self._parts[0]


def _pass(rows: DataFrame, block: pa.Table, function: Callable, schema: str) -> DataFrame:
    """Apply ``function(batches, block) -> columns`` to each task's rows."""
    spark = rows.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(block)
    wanted = arrow_types(schema)

    def run(batches):
        columns = function(batches, _Block(sent.value))
        yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(columns, wanted, strict=True)], schema=wanted)

    return rows.mapInArrow(run, schema)


def _positives(keep: int):
    def run(batches, block):
        heaps = _Heaps(keep)
        for ids, labels, part, scores in _scored(batches, block):
            other = (block.labels[part, None] != labels) | (block.ids[part, None] == ids)
            scores[other] = _NONE
            at, column, value = best(scores, keep)
            heaps.push(at + part.start, ids[column], value)
        keys, ids, scores = heaps.result()
        return block.ids[keys], ids, scores

    return run


def _negatives(keep: int):
    def run(batches, block):
        heaps, slots = _Heaps(keep), block.low.shape[1]
        for ids, labels, part, scores in _scored(batches, block):
            differs = block.labels[part, None] != labels
            for slot in range(slots):
                inside = differs & (scores >= block.low[part, slot, None]) & (scores <= block.high[part, slot, None])
                at, column, value = best(np.where(inside, scores, _NONE), keep)
                heaps.push((at + part.start) * slots + slot, ids[column], value)
        keys, ids, scores = heaps.result()
        anchor, slot = np.divmod(keys, max(slots, 1))
        return block.ids[anchor], block.positive[anchor, slot], block.score[anchor, slot], ids, scores

    return run


def _in_blocks(rows: DataFrame, anchors: DataFrame, function: Callable, schema: str, keep: int) -> DataFrame:
    """The heaps of all blocks of anchors, merged and stored: the key's columns, the other row's id, its score and place."""
    spark = rows.sparkSession
    *keys, other, score = arrow_types(schema).names
    many, numbers = anchors.agg(F.count("*"), F.sum(F.size("v") + 1)).first()
    blocks = 1 + (numbers or 0) // NUMBERS_A_BLOCK
    path = new_path(spark, other)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(score), other))
    result = spark.createDataFrame([], f"{schema}, place int")
    result.write.parquet(path)
    for k in range(blocks if many else 0):
        block = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == k).toArrow()
        if block.num_rows:
            heaps = _pass(rows, block, function, schema)
            heaps.withColumn("place", place).where(F.col("place") <= keep).write.mode("append").parquet(path)
    return spark.read.schema(result.schema).parquet(path)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: the hardest negatives of each positive.

    Components become floor(256 x); scores are inner products, higher first, smaller ids first among equals. A
    positive is one of the first ``positives`` other rows of the anchor's label, a negative one of the first
    ``negatives`` rows of other labels with ``low * positive <= 100 * score <= high * positive``. Rows with a null id,
    label or vector or with a component that is null or not finite take no part. Vectors of other lengths are compared as
    if they ended in zeros. Rows that repeat an id count each, but never as "other" rows of an anchor with that id; if an
    anchor's id repeats, the row with the smallest label and vector is the anchor, and a positive that repeats with the
    same score is mined once. Scores are exact as long as they fit
    a long, and components beyond a long are taken as its bounds. An empty table, or one without anchors, gives no rows.
    """
    anchor_rows = usable(vectors.where(F.coalesce(is_anchor, F.lit(False))), id_col, vector_col, label_col)
    least = anchor_rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("least"))
    anchors = as_table(least.select("vec_id", "least.*"), "anchors")
    rows = usable(vectors, id_col, vector_col, label_col)
    same = _in_blocks(rows, anchors, _positives(positives), "anchor_id long, positive_id long, score long", positives)
    score = F.col("score").cast("decimal(38,0)")
    windows = (
        same.select(
            F.col("anchor_id").alias("vec_id"),
            F.struct(
                "positive_id",
                "score",
                F.ceil(score * low / 100).cast("long").alias("low"),
                F.floor(score * high / 100).cast("long").alias("high"),
            ).alias("window"),
        )
        .where("window.low <= window.high")
        .groupBy("vec_id")
        .agg(F.collect_set("window").alias("windows"))  # at most ``positives`` of them
    )
    return _in_blocks(
        rows,
        as_table(anchors.join(windows, "vec_id"), "windows"),
        _negatives(negatives),
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long",
        negatives,
    ).select("anchor_id", "positive_id", F.col("place").alias("rank"), "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(vectors: DataFrame) -> DataFrame:
    """Anchors are the ids divisible by 50; of ids divisible by 7 the label moves on by one, modulo 10."""
    vec_id = F.col("vec_id")
    moved = F.when(vec_id % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.select("vec_id", "embedding", moved.alias("label")), vec_id % 50 == 0)
