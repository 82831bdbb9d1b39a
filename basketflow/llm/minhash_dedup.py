"""Near-duplicate documents by a chosen-path set similarity join over minwise tokens.

Documents with equal shingle sets form one class. Every class has minwise values; a tree sends it from node to node,
each node choosing one coordinate (sometimes two, so that a pair at the threshold is expected to go on together) and
the class's value there the child. Several independent trees start at different coordinates. In small nodes all
classes are compared by their minwise values, and the pairs that pass on their full shingle sets. In a large node
all are first compared with one of its classes; as only components are wanted, it is then finished if that connects
it, and otherwise branches on. That takes apart what has little in common; nodes that stay large are groups of close
texts. Their shingle sets are compared block by block, two blocks a task, and a task returns no more than a forest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import arrow_types, id_and_text, map_texts, ship, told_apart, without
from basketflow.llm.graph import components, forest
from basketflow.llm.words import mixed, odd, shingle_sets
from basketflow.shared import as_table

#: Minwise values that trees branch on, and further ones of which one byte is kept for estimates.
COORDINATES, FURTHER = 64, 192
#: Nodes of at most so many classes are compared at once; those of at most MIDDLE by blocks, from level BRANCHED on.
SMALL, MIDDLE = 64, 16_384
BRANCHED, LEVELS = 2, 12
BLOCK = 512
BROADCAST_ROWS = 2_000_000


@dataclass(frozen=True)
class Threshold:
    """Links need 100 * intersection >= ``percent`` * union.

    A pair at the threshold meets in no tree, or agrees in fewer than ``agree`` coordinates, with a probability
    below 1e-4 together.
    """

    percent: int
    trees: int
    agree: int

    @property
    def roots(self) -> np.ndarray:
        return np.arange(self.trees) * (COORDINATES // self.trees)


USUAL, CLOSE = Threshold(80, 13, 176), Threshold(85, 10, 190)

_FACTORS = odd(COORDINATES + FURTHER, 17)
#: Bytes of the values of a class.
_WIDE, _ALL = 4 * COORDINATES, 4 * COORDINATES + FURTHER


def _minima(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Minwise values of each set, texts x bytes; all ones for an empty set."""
    found = np.full((len(counts), COORDINATES + FURTHER), 0xFFFFFFFF, dtype=np.uint32)
    full = np.flatnonzero(counts)
    if len(full):
        starts = (np.cumsum(counts) - counts)[full]
        spread = hashes ^ (hashes >> np.uint64(29))
        for k, factor in enumerate(_FACTORS):
            values = (spread * factor) >> np.uint64(32)
            found[full, k] = np.minimum.reduceat(values.astype(np.uint32), starts)
    wide = np.ascontiguousarray(found[:, :COORDINATES]).view(np.uint8).reshape(len(counts), _WIDE)
    return np.concatenate([wide, found[:, COORDINATES:].astype(np.uint8)], axis=1)


def sign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, number of shingles, two hashes of the set and its minwise values."""

    def run(piece, texts):
        hashes, counts = shingle_sets(texts)
        ends = np.cumsum(counts)
        f, g = (np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes + np.uint64(s)), dtype=np.uint64)]) for s in (1, 2))
        minima = _minima(hashes, counts)
        return {
            "doc_id": piece.column(0),
            "n": counts,
            "f": pa.array((f[ends] - f[ends - counts]).view(np.int64)),
            "g": pa.array((g[ends] - g[ends - counts]).view(np.int64)),
            "minima": pa.array([row.tobytes() for row in minima], pa.binary()),
        }

    return map_texts(id_and_text(docs, id_col, text_col), run, "doc_id long, n long, f long, g long, minima binary")


def _rows(values: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(values.to_pylist()), dtype=np.uint8).reshape(len(values), _ALL)


def _wide(rows: np.ndarray) -> np.ndarray:
    """The values that trees branch on."""
    return np.ascontiguousarray(rows[:, :_WIDE]).view(np.uint32)


def _child(path: np.ndarray, coordinate: np.ndarray, value: np.ndarray) -> np.ndarray:
    return mixed(path * np.uint64(0x9E3779B97F4A7C15) + (coordinate.astype(np.uint64) << np.uint64(40)) + value).view(np.int64)


def _roots(classes: DataFrame, at: Threshold) -> DataFrame:
    """The first nodes: each tree starts at a coordinate of its own."""
    ship(classes.sparkSession)

    def run(batches):
        for batch in batches:
            minima = _wide(_rows(batch.column(1)))
            for tree, coordinate in enumerate(at.roots):
                path = np.full(len(minima), tree, dtype=np.uint64)
                keys = _child(path, np.full(len(minima), coordinate), minima[:, coordinate])
                yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column(0)], names=["node", "class"])

    return classes.select("class", "minima").mapInArrow(run, "node long, class long")


def _branched(rows: DataFrame, limit: Threshold) -> DataFrame:
    """Children of nodes: one coordinate that the node's path chooses, and with probability 100/percent - 1 a second."""
    ship(rows.sparkSession)

    def run(batches):
        for batch in batches:
            path = batch.column(0).to_numpy().view(np.uint64)
            minima = _wide(_rows(batch.column(2)))
            for turn in (0, 1):
                chosen = mixed(path + np.uint64(turn + 1))
                go = np.arange(len(path)) if turn == 0 else np.flatnonzero(mixed(path + np.uint64(9)) % np.uint64(1000) < 1000 * (100 / limit.percent - 1))
                at = (chosen[go] % np.uint64(COORDINATES)).astype(np.int64)
                keys = _child(path[go], at, minima[go, at])
                yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column(1).take(pa.array(go))], names=["node", "class"])

    return rows.select("node", "class", "minima").mapInArrow(run, "node long, class long")


def _shared_nodes(rows: DataFrame, level: int) -> DataFrame:
    """Rows of nodes with more than one class, with the node's size and one of its classes."""
    stats = rows.groupBy("node").agg(
        F.count("*").alias("size"), F.min(F.struct(F.xxhash64("class", F.lit(level)).alias("h"), "class"))["class"].alias("pivot")
    )
    return rows.join(stats.where("size > 1"), "node")


def _stars(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of each class and the one chosen from its node."""
    return rows.where("class != pivot").select(F.col("class").alias("a"), F.col("pivot").alias("b")).distinct()


def _similar(sizes_a, sizes_b, minima_a, minima_b, limit: Threshold) -> np.ndarray:
    fits = 100 * np.minimum(sizes_a, sizes_b) >= limit.percent * np.maximum(sizes_a, sizes_b)
    near = np.flatnonzero(fits)
    for begin in range(0, len(near), 20_000):
        at = near[begin : begin + 20_000]
        a, b = minima_a[at], minima_b[at]
        same = (_wide(a) == _wide(b)).sum(axis=1) + (a[:, _WIDE:] == b[:, _WIDE:]).sum(axis=1)
        fits[at] = same >= limit.agree
    return fits


def _estimated(pairs: DataFrame, classes: DataFrame, limit: Threshold) -> DataFrame:
    """Pairs (a, b) whose sizes and minwise values allow a link."""
    ship(pairs.sparkSession)
    both = pairs
    for side in ("a", "b"):
        both = both.join(classes.select(F.col("class").alias(side), F.col("n").alias(f"n_{side}"), F.col("minima").alias(f"m_{side}")), side)

    def run(batches):
        for batch in batches:
            fits = _similar(batch.column(2).to_numpy(), batch.column(3).to_numpy(), _rows(batch.column(4)), _rows(batch.column(5)), limit)
            yield batch.select(["a", "b"]).filter(pa.array(fits))

    return both.select("a", "b", "n_a", "n_b", "m_a", "m_b").mapInArrow(run, "a long, b long")


def _compared(rows: DataFrame, limit: Threshold) -> DataFrame:
    """Pairs of different components within small nodes whose sizes and minwise values allow a link.

    Rows arrive sorted by node; neighbours at growing distance are compared for many nodes at once.
    """
    ship(rows.sparkSession)

    def pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
        node, ids, group, sizes = (table[k].to_numpy() for k in ("node", "class", "component", "n"))
        minima = _rows(table["minima"].combine_chunks())
        for apart in range(1, len(node)):
            same = np.flatnonzero(node[:-apart] == node[apart:])
            if not len(same):
                break
            i = same[group[same] != group[same + apart]]
            i = i[_similar(sizes[i], sizes[i + apart], minima[i], minima[i + apart], limit)]
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(ids[i + apart])], names=["a", "b"])

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            node = table["node"].to_numpy()
            cut = int(np.searchsorted(node, node[-1])) if len(node) else 0
            rest = table.slice(cut)
            if cut:
                yield from pairs(table.slice(0, cut))
        if rest is not None and rest.num_rows:
            yield from pairs(rest)

    sorted_rows = rows.select("node", "class", "component", "n", "minima").repartition("node").sortWithinPartitions("node")
    return sorted_rows.mapInArrow(run, "a long, b long")


def _common(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Number of common shingles of every two sets, given one after the other with their sizes."""
    n = len(counts)
    owner = np.repeat(np.arange(n), counts)
    order = np.argsort(first, kind="stable")
    values, owner = first[order], owner[order]
    new = np.concatenate([[True], values[1:] != values[:-1]]) if len(values) else np.zeros(0, bool)
    column = np.cumsum(new) - 1
    several = np.bincount(column, minlength=1)[column] > 1
    owner, column = owner[several], column[several]
    column = np.cumsum(np.concatenate([[0], np.diff(column) != 0])) if len(column) else column
    total = np.zeros((n, n), dtype=np.float64)
    for low in range(0, int(column.max(initial=-1)) + 1, 4096):
        a, b = np.searchsorted(column, (low, low + 4096))
        member = np.zeros((n, 4096), dtype=np.float32)
        member[owner[a:b], column[a:b] - low] = 1
        total += member @ member.T
    return total


def _by_blocks(rows: DataFrame, docs: DataFrame, classes: DataFrame, limit: Threshold) -> DataFrame:
    """A forest of links between components in nodes of any size: every two blocks of a node meet in a task of their own."""
    ship(rows.sparkSession)
    sets = _sets(rows.select("class").distinct(), docs, classes)
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = (
        rows.select("node", "class", "component", blocks.alias("blocks"), F.pmod(F.xxhash64("class"), blocks).cast("int").alias("own"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("node", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "class", "component")
        .join(sets, "class")
    )
    schema = arrow_types("a long, b long")

    def compare(key, table):
        ids, group = table["class"].to_numpy(), table["component"].to_numpy()
        sets_of = table["shingles"].to_pylist()
        counts = np.array([len(x) // 8 for x in sets_of], dtype=np.int64)
        common = _common(np.frombuffer(b"".join(sets_of), dtype=np.uint64), counts)
        linked = 100 * common >= limit.percent * (counts[:, None] + counts[None, :] - common)
        a, b = np.nonzero(np.triu(linked & (group[:, None] != group[None, :]), 1))
        child, root = forest(len(ids), a, b)
        return pa.Table.from_arrays([pa.array(ids[child]), pa.array(ids[root])], schema=schema)

    return placed.groupBy("node", "low", "high").applyInArrow(compare, "a long, b long")


def _sets(wanted: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """class and shingles of the classes in ``wanted``, from the texts of their smallest documents."""
    wanted = as_table(wanted.join(classes.select("class", F.col("f").alias("set_hash")), "class"), "wanted")
    ids = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    texts = docs.join(ids, docs["doc_id"] == ids["class"]).select("doc_id", "text", "set_hash")

    def run(piece, found):
        hashes, counts = shingle_sets(found)
        ends = np.cumsum(counts)
        total = np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes + np.uint64(1)), dtype=np.uint64)])
        raw = hashes.tobytes()
        return {
            "class": piece.column(0),
            "same": (total[ends] - total[ends - counts]).view(np.int64) == piece.column(2).to_numpy(),
            "shingles": pa.array([raw[8 * (e - n) : 8 * e] for e, n in zip(ends, counts, strict=True)], pa.binary()),
        }

    # rows that repeat an id with another text are no member of the class; equal rows are needed once
    found = map_texts(texts, run, "class long, same boolean, shingles binary").where("same").drop("same")
    return as_table(found, "sets").dropDuplicates(["class"])


def _confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, limit: Threshold) -> DataFrame:
    """The pairs that are links on their full shingle sets."""
    ship(pairs.sparkSession)
    sets = _sets(pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct(), docs, classes)
    both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b").select("a", "b", "set_a", "set_b")

    def compare(batches):
        for batch in batches:
            a, b = batch.column(2), batch.column(3)
            fits = []
            for x, y in zip(a, b, strict=True):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                common = len(x) + len(y) - len(np.union1d(x, y))
                fits.append(100 * common >= limit.percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(fits, pa.bool_()))

    return both.mapInArrow(compare, "a long, b long")


def link_documents(docs: DataFrame, limit: Threshold = USUAL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Documents are linked if the Jaccard similarity of their five-word shingle sets reaches the limit's; component_id is
    the smallest id reachable, kept says that it is the row's own. Null and empty texts have no shingles and link
    with nothing. Rows with equal sets share a component, rows that repeat an id get a result each. A row with a
    null id links nothing and is kept only if it equals no row with an id. What is linked was confirmed on the full sets.
    A link at the threshold is missed with probability below 1e-4 if its texts meet in nodes of at most ``MIDDLE`` classes;
    in groups of more texts that stay together down to the last level, with about 2 %, unless others connect them.
    """
    docs = id_and_text(docs, id_col, text_col)
    signed = as_table(sign(docs), "signed")
    classes = as_table(
        signed.where("n > 0 and doc_id is not null").groupBy("n", "f", "g").agg(F.min("doc_id").alias("class"), F.min("minima").alias("minima")), "classes"
    )
    rows = as_table(_shared_nodes(_roots(classes, limit), 0), "nodes")
    links = as_table(_confirmed(as_table(_estimated(_stars(rows), classes, limit), "pairs"), docs, classes, limit), "links")
    labels = as_table(components(links), "labels")
    more_links = []
    for level in range(LEVELS + 1):
        current = as_table(_mixed_nodes(rows, labels, classes), "mixed")
        compared = _compared(current.where(F.col("size") <= SMALL), limit)
        settled = MIDDLE if level < LEVELS else float("inf")
        in_blocks = current.where((F.col("size") > SMALL) & (F.col("size") <= settled) & F.lit(level >= BRANCHED))
        large = current.where((F.col("size") > (SMALL if level < BRANCHED else settled)))
        more = not large.isEmpty()
        if more:
            rows = as_table(_shared_nodes(_branched(large, limit), level + 1), "nodes")
            compared = compared.unionAll(_estimated(_stars(rows), classes, limit))
        candidates = as_table(compared.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "pairs")
        if not candidates.isEmpty():
            more_links.append(as_table(_confirmed(candidates, docs, classes, limit), "links"))
        if not in_blocks.isEmpty():
            more_links.append(as_table(_by_blocks(in_blocks, docs, classes, limit), "links"))
        if not more:
            break
    if more_links:  # components of the stars only spared comparisons; these are those of all links
        labels = components(reduce(DataFrame.unionAll, more_links, links))
    named = classes.join(labels.withColumnRenamed("node", "class"), "class", "left").select("n", "f", "g", F.coalesce("component", "class").alias("component"))
    joined = signed.where("n > 0").join(named, ["n", "f", "g"], "left").select("doc_id", "n", F.coalesce("component", "doc_id").alias("component_id"))
    empty = signed.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return joined.unionAll(empty).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def one_of_each(docs: DataFrame, limit: Threshold = USUAL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group that links make, the row with the smallest id stays.

    Rows are judged by their own texts, also where ids repeat or are missing: among rows with the same id the one with
    the smallest hash of its text stays, and rows without an id stay where none of the group has one. Rows that agree in id
    and text are one, of which one stays. Null and empty texts link with nothing.
    """
    keyed, key = told_apart(docs, id_col, text_col)
    linked = link_documents(keyed, limit, key, text_col)
    if key == id_col:
        return without(docs, linked.where("not kept").select("doc_id"), id_col)
    ids = keyed.select(F.col(key).alias("doc_id"), F.col(id_col).alias("id")).distinct()
    first = linked.distinct().join(ids, "doc_id").groupBy("component_id").agg(
        F.min(F.struct(F.col("id").isNull().alias("missing"), "id", "doc_id"))["doc_id"].alias("stays")
    )
    stays = as_table(first.select(F.col("stays").alias(key)), "stays")
    once = as_table(keyed.join(stays, key, "left_semi").dropDuplicates([key]), "once")
    return once.select(*docs.columns)


def _mixed_nodes(rows: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows of nodes that hold more than one component, with component, set size and minwise values."""
    labelled = (
        rows.select("node", "class", "size")
        .join(labels.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    spread = labelled.groupBy("node").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    return labelled.join(spread.select("node"), "node").join(classes.select("class", "n", "minima"), "class")
