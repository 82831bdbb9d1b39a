"""Words that repeat a passage of an earlier document, found by fixed-block anchors.

A repeat of ``window`` words, wherever it starts, covers a whole block of ``(window + 1) / 2`` words of the document
it is compared with, if that document is cut into blocks without overlap. So the blocks of all documents are the
index and every rolling sequence of that length in any document is a probe; both travel as short hashes packed by
hash range, and what is found comes back packed by bucket of documents, so that rows follow the words and not the
documents times the ranges. Around the anchors that hit, the windows themselves are hashed with 128 bits, and each window takes the
smallest document that has it; runs of such windows are the maximal exact repeats.

Tasks settle what they can alone: of all documents of a task that share a sequence one stands for the others, so a
passage of many documents sends one entry a task. Copies of a whole document are set aside first.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import id_and_text, map_texts, ship, slices, texts_of, without
from basketflow.llm.words import hash_words, mixed, windows
from basketflow.shared import as_table

WINDOW = 13
ENTRIES_A_RANGE = 2_500_000
ENTRIES_AT_ONCE = 2_000_000
_TAG = np.uint64((1 << 32) - 1)
_SALT = np.uint64(0x9E3779B97F4A7C15)


def _packed_ids(ids: np.ndarray) -> bytes:
    """Ascending ids as differences of the smallest width that holds them."""
    raw = ids.astype(np.int64).view(np.uint64)
    gaps = np.diff(raw, prepend=raw[:1])
    width = next(w for w in (2, 4, 8) if w == 8 or not len(gaps) or int(gaps.max()) < 1 << (8 * w))
    return bytes([width]) + raw[:1].tobytes() + gaps.astype(f"u{width}").tobytes()


def _unpacked_ids(raw: bytes) -> np.ndarray:
    gaps = np.frombuffer(raw, dtype=f"u{raw[0]}", offset=9).astype(np.uint64)
    return (np.frombuffer(raw, dtype=np.uint64, count=1, offset=1) + np.cumsum(gaps)).view(np.int64)


def _place(hashes: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Range of a hash and its 32-bit tag within it."""
    return (hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32), (hashes & _TAG).astype(np.uint32)


def _bucket(ids: np.ndarray, buckets: int) -> np.ndarray:
    return ((mixed(ids.view(np.uint64) + _SALT) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of equal values."""
    if not len(values):
        return []
    cuts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1], [True]]))
    return list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))


def _bits(packed: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    return [np.unpackbits(np.frombuffer(x, dtype=np.uint8), count=n) for x, n in zip(packed, sizes, strict=True)]


def word_sequences(docs: DataFrame) -> DataFrame:
    """doc_id, number of words and a 128-bit hash of the whole sequence of words."""

    def run(piece, texts):
        sums = []
        for seed in (1, 2):
            words, counts = hash_words(texts, seed=seed)
            at = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
            total = np.concatenate([[np.uint64(0)], np.cumsum(mixed(words + at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), dtype=np.uint64)])
            ends = np.cumsum(counts)
            sums.append(pa.array((total[ends] - total[ends - counts]).view(np.int64)))
        return {"doc_id": piece.column(0), "n_words": counts, "f": sums[0], "g": sums[1]}

    return map_texts(docs, run, "doc_id long, n_words long, f long, g long")


def _anchors(docs: DataFrame, block: int, window: int, ranges: int) -> DataFrame:
    """Probes and index entries packed by range; what a task already knows to be shared goes along as hits."""

    def entries(batches) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        held, size = [], 0
        for piece in slices(batches):
            words, counts = hash_words(texts_of(piece))
            hashes, first = windows(words, counts, block)
            owner = np.repeat(np.arange(len(counts)), counts)[first]
            keep = counts[owner] >= window
            hashes, first, owner = hashes[keep], first[keep], owner[keep]
            index = (first - (np.cumsum(counts) - counts)[owner]) % block == 0
            held.append((hashes, piece.column(0).to_numpy()[owner], index))
            size += len(hashes)
            if size > ENTRIES_AT_ONCE:
                yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                held, size = [], 0
        if size:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))

    def run(batches):
        for hashes, ids, index in entries(batches):
            order = np.lexsort((~index, ids, hashes))  # of equal hash and id, an index entry comes first
            hashes, ids, index = hashes[order], ids[order], index[order]
            new_hash = np.concatenate([[True], hashes[1:] != hashes[:-1]])
            new = new_hash | np.concatenate([[True], ids[1:] != ids[:-1]])
            group = (np.cumsum(new_hash) - 1)[new]
            hashes, ids, index = hashes[new], ids[new], index[new]
            several = np.bincount(group)[group] > 1
            any_index = np.bincount(group, index)[group] > 0
            sent = np.concatenate([[True], group[1:] != group[:-1]])
            for kind, chosen in ((0, sent & ~several), (1, sent & several), (2, several)):
                yield from packets(kind, hashes[chosen], ids[chosen], any_index[chosen])

    def packets(kind, hashes, ids, index):
        place, tags = _place(hashes, ranges)
        order = np.lexsort((ids, place))
        place, tags, ids, index = (x[order] for x in (place, tags, ids, index))
        cuts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1], [True]])) if len(place) else np.zeros(1, np.int64)
        for begin in range(0, len(cuts) - 1, 256):
            ends = cuts[begin : begin + 257]
            spans = list(zip(ends[:-1], ends[1:], strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(place[ends[:-1]].astype(np.int64)),
                    pa.array([kind] * len(spans), pa.int32()),
                    pa.array([tags[a:b].tobytes() for a, b in spans], pa.binary()),
                    pa.array([np.packbits(index[a:b]).tobytes() for a, b in spans], pa.binary()),
                    pa.array([_packed_ids(ids[a:b]) for a, b in spans], pa.binary()),
                ],
                names=["range", "kind", "tags", "indexed", "ids"],
            )

    ship(docs.sparkSession)
    return docs.mapInArrow(run, "range long, kind int, tags binary, indexed binary, ids binary")


def _hits(packets: DataFrame, buckets: int) -> DataFrame:
    """doc_id and tags of the sequences that another document has too: those with an index block among them, and others.

    A range sends one row to each bucket of documents, and a bucket's task gives one row a document.
    """
    packed = pa.schema([("bucket", pa.int64()), ("tags", pa.binary()), ("anchors", pa.binary()), ("ids", pa.binary())])
    by_document = pa.schema([("doc_id", pa.int64()), ("tags", pa.binary()), ("others", pa.binary())])

    def met(table: pa.Table) -> pa.Table:
        kinds = table["kind"].to_pylist()
        tags = [np.frombuffer(x, dtype=np.uint32) for x in table["tags"].to_pylist()]
        ids = [_unpacked_ids(x) for x in table["ids"].to_pylist()]
        index = _bits(table["indexed"].to_pylist(), list(map(len, tags)))
        kind = np.repeat(kinds, [len(t) for t in tags])
        tags, ids, index = np.concatenate(tags), np.concatenate(ids), np.concatenate(index)
        sent = kind < 2
        found, inverse = np.unique(tags[sent], return_inverse=True)
        several = (np.bincount(inverse, minlength=len(found)) > 1)[inverse] & (kind[sent] == 0)
        indexed = np.bincount(inverse, index[sent], len(found)) > 0
        tags = np.concatenate([tags[sent][several], tags[kind == 2]])
        ids = np.concatenate([ids[sent][several], ids[kind == 2]])
        anchors = indexed[np.searchsorted(found, tags)]
        bucket = _bucket(ids, buckets)
        order = np.lexsort((ids, bucket))
        tags, ids, anchors, bucket = tags[order], ids[order], anchors[order], bucket[order]
        runs = _runs(bucket)
        return pa.Table.from_arrays(
            [
                pa.array([bucket[a] for a, _ in runs], pa.int64()),
                pa.array([tags[a:b].tobytes() for a, b in runs], pa.binary()),
                pa.array([np.packbits(anchors[a:b]).tobytes() for a, b in runs], pa.binary()),
                pa.array([_packed_ids(ids[a:b]) for a, b in runs], pa.binary()),
            ],
            schema=packed,
        )

    def gathered(table: pa.Table) -> pa.Table:
        tags = [np.frombuffer(x, dtype=np.uint32) for x in table["tags"].to_pylist()]
        anchors = np.concatenate(_bits(table["anchors"].to_pylist(), list(map(len, tags)))) > 0
        tags, ids = np.concatenate(tags), np.concatenate([_unpacked_ids(x) for x in table["ids"].to_pylist()])
        order = np.argsort(ids, kind="stable")
        tags, ids, anchors = tags[order], ids[order], anchors[order]
        runs = _runs(ids)
        return pa.Table.from_arrays(
            [
                pa.array([ids[a] for a, _ in runs], pa.int64()),
                pa.array([tags[a:b][anchors[a:b]].tobytes() for a, b in runs], pa.binary()),
                pa.array([tags[a:b][~anchors[a:b]].tobytes() for a, b in runs], pa.binary()),
            ],
            schema=by_document,
        )

    found = packets.groupBy("range").applyInArrow(met, "bucket long, tags binary, anchors binary, ids binary")
    return found.groupBy("bucket").applyInArrow(gathered, "doc_id long, tags binary, others binary")


def _repeat_windows(docs: DataFrame, hits: DataFrame, block: int, window: int) -> DataFrame:
    """Windows around anchors: 128-bit hash, document and first word; without a hash where the task knows them as covered,
    all those of a document together."""
    rows = docs.join(hits, "doc_id").select("doc_id", "text", "tags", "others")

    def windows_of(batches):
        held, size = [], 0
        for piece in slices(batches):
            texts = texts_of(piece)
            words, counts = hash_words(texts)
            anchors, first = windows(words, counts, block)
            owner = np.repeat(np.arange(len(counts)), counts)
            # the tags of a document are matched together with its number in the piece
            key = owner[first].astype(np.int64) << 32 | (anchors & _TAG).astype(np.int64)
            through = []
            for column in (2, 3):
                wanted = [np.int64(k) << 32 | np.frombuffer(x, dtype=np.uint32).astype(np.int64) for k, x in enumerate(piece.column(column).to_pylist())]
                mine = np.zeros(len(words) + window, dtype=bool)
                mine[first] = np.isin(key, np.concatenate(wanted))
                through.append(np.concatenate([[0], np.cumsum(mine)]))
            whole, begin = windows(words, counts, window, seed=5)
            other, _ = windows(hash_words(texts, seed=2)[0], counts, window, seed=6)
            # around an anchor, a repeat goes on as long as every sequence is shared
            inner = window - block + 1
            anchored, others = (x[begin + inner] - x[begin] for x in through)
            repeats = (anchored > 0) & (anchored + others == inner)
            begin, whole, other = begin[repeats], whole[repeats], other[repeats]
            place = begin - (np.cumsum(counts) - counts)[owner[begin]]
            held.append((whole.view(np.int64), other.view(np.int64), piece.column(0).to_numpy()[owner[begin]], place))
            size += len(begin)
            if size > ENTRIES_AT_ONCE // 2:
                yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                held, size = [], 0
        if size:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))

    def run(batches):
        for f, g, ids, place in windows_of(batches):
            order = np.lexsort((ids, g, f))
            f, g, ids, place = f[order], g[order], ids[order], place[order]
            new = np.concatenate([[True], (f[1:] != f[:-1]) | (g[1:] != g[:-1])])
            least = ids[np.flatnonzero(new)][np.cumsum(new) - 1]
            covered = ids > least
            open_ = np.flatnonzero(~covered)
            for begin in range(0, len(open_), 100_000):
                at = open_[begin : begin + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f[at]), pa.array(g[at]), pa.array(ids[at]), pa.ListArray.from_arrays(np.arange(len(at) + 1, dtype=np.int32), pa.array(place[at].astype(np.int32)))],
                    names=["f", "g", "doc_id", "places"],
                )
            order = np.flatnonzero(covered)
            order = order[np.lexsort((place[order], ids[order]))]
            cuts = np.flatnonzero(np.concatenate([[True], np.diff(ids[order]) != 0, [True]])) if len(order) else np.zeros(1, np.int64)
            none = pa.nulls(len(cuts) - 1, pa.int64())
            lists = pa.ListArray.from_arrays(cuts.astype(np.int32), pa.array(place[order].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([none, none, pa.array(ids[order[cuts[:-1]]]), lists], names=["f", "g", "doc_id", "places"])

    ship(docs.sparkSession)
    return rows.mapInArrow(run, "f long, g long, doc_id long, places array<int>")


def _covered(found: DataFrame) -> DataFrame:
    """doc_id and places of windows that a smaller document has: rows of a window stream by, smallest document first."""
    spread = found.repartition(F.coalesce("f", F.xxhash64("doc_id", "places"))).sortWithinPartitions("f", "g", "doc_id")

    def run(batches):
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            known = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            f, g = (batch.column(k).fill_null(0).to_numpy() for k in (0, 1))
            ids = batch.column(2).to_numpy()
            new = np.concatenate([[True], (f[1:] != f[:-1]) | (g[1:] != g[:-1]) | (known[1:] != known[:-1])])
            least = ids[np.flatnonzero(new)]
            if last is not None and not known[0] and last[:2] == (f[0], g[0]):
                least[0] = last[2]
            group = np.cumsum(new) - 1
            covered = known | (ids > least[group])
            last = None if known[-1] else (f[-1], g[-1], least[group[-1]])
            yield batch.select(["doc_id", "places"]).filter(pa.array(covered))

    return spread.mapInArrow(run, "doc_id long, places array<int>")


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words left, joined by one space) of every row.

    A word goes if a window of ``window`` words that covers it also starts in a document with a smaller id. Null and
    empty texts have no words. Nothing is removed from a row with a null id, and none serves as the earlier document.
    Rows that repeat an id count as one document: what repeats in one of them is removed at that place in all.
    """
    block = (window + 1) // 2
    docs = id_and_text(docs, id_col, text_col)
    known = docs.where("doc_id is not null")
    sequences = as_table(word_sequences(known), "sequences")
    first = sequences.where(F.col("n_words") >= window).groupBy("n_words", "f", "g").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    copies = as_table(
        sequences.join(first.where("first < last"), ["n_words", "f", "g"]).where("doc_id > first").select("doc_id").distinct(), "copies"
    )
    originals = without(known, copies)
    words = sequences.agg(F.sum("n_words")).first()[0] or 0
    ranges = max(1, words // ENTRIES_A_RANGE)
    hits = as_table(_hits(_anchors(originals, block, window, ranges), ranges), "hits")
    windows_found = as_table(_covered(_repeat_windows(originals, hits, block, window)), "covered")
    places = windows_found.select("doc_id", "places", F.lit(False).alias("copy")).unionAll(
        copies.select("doc_id", F.lit(None).cast("array<int>"), F.lit(True))
    )
    merged = places.groupBy("doc_id").agg(F.flatten(F.collect_list("places")).alias("places"), F.max("copy").alias("copy"))
    rows = docs.join(merged, "doc_id", "left").select("doc_id", "text", "places", "copy")

    def run(piece, texts):
        n_words, n_removed, kept = [], [], []
        for text, places, copy in zip(texts, piece.column(2), piece.column(3).to_pylist(), strict=True):
            words = text.encode().split()
            stays = np.full(len(words), not copy)
            if places.is_valid and len(places):
                begin = places.values.to_numpy()
                begin = begin[begin <= len(words) - window]
                edges = np.bincount(begin, minlength=len(words) + 1) - np.bincount(begin + window, minlength=len(words) + 1)
                stays &= np.cumsum(edges)[: len(words)] == 0
            left = int(stays.sum())
            n_words.append(len(words))
            n_removed.append(len(words) - left)
            kept.append(b" ".join(words if left == len(words) else compress(words, stays)))
        return {"doc_id": piece.column(0), "n_words": n_words, "n_removed": n_removed, "kept": [x.decode() for x in kept]}

    return map_texts(rows, run, "doc_id long, n_words long, n_removed long, kept string")


def digests(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))

