"""Lines that many documents share, found by two Bloom filters: keys seen once, and keys seen again.

A filter over all lines of a large corpus fits no executor, so it is cut by range of the keys' hash, and a task holds
both filters of one range. A task over documents knows by itself which of its keys several of its documents have; of
each key it sends one entry to the range. An entry that finds its bits in the first filter goes to the second; what the
second filter holds in the end is suspected. Only the suspected lines go on, as 128-bit hash and document, to be counted
exactly and to have the document named that keeps them; a false alarm of a filter costs a row there and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import id_and_text, map_texts, ship, slices, texts_of
from basketflow.llm.words import mixed
from basketflow.shared import as_table

MIN_CHARS, MIN_DOCS = 20, 3
#: Entries a filter is made for, and what a task over documents gathers before it sends.
ENTRIES_A_RANGE, ENTRIES_AT_ONCE = 1_000_000, 1_000_000
#: Keys that are tested together before they are added to the first filter.
KEYS_AT_ONCE = 65_536
#: Bits a filter has for each entry (rounded up to a power of two), and bits a key sets.
BITS_AN_ENTRY, PROBES = 16, 4
#: What is broadcast at most: rows of 24 bytes with a verdict, bytes of hashes to drop.
BROADCAST_VERDICTS, BROADCAST_BYTES = 1_000_000, 64_000_000

_WHITE = " \t\n\x0b\x0c\r"
_HASH = np.dtype([("high", "<u8"), ("low", "<u8")])


def line_key(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """What makes lines equal: ASCII white space off both ends, A-Z in lower case; None if too short."""
    key = line.strip(_WHITE)
    return key.encode().lower() if len(key) >= min_chars else None


def _hash(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _cuts(values: np.ndarray) -> np.ndarray:
    """Begins of the runs of equal values, and the end."""
    if not len(values):
        return np.zeros(1, np.int64)
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1], [True]]))


class Bloom:
    """Bits of one range; the size is a power of two."""

    def __init__(self, entries: int):
        self._shift = np.uint64(64 - max(6, (entries * BITS_AN_ENTRY - 1).bit_length()))
        self._bits = np.zeros(1 << int(64 - self._shift), dtype=bool)

    def _at(self, keys: np.ndarray) -> Iterator[np.ndarray]:
        step = mixed(keys) | np.uint64(1)
        return (mixed(keys + np.uint64(k) * step) >> self._shift for k in range(1, PROBES + 1))

    def add(self, keys: np.ndarray) -> None:
        for at in self._at(keys):
            self._bits[at] = True

    def holds(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), dtype=bool)
        for at in self._at(keys):
            found &= self._bits[at]
        return found


def _entries(docs: DataFrame, ranges: int, min_chars: int) -> DataFrame:
    """Packed by range: keys that one document of the task has, keys that several have (with one of these documents),
    and as rows without a range the other documents of the latter."""

    def gathered(batches) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        hashes, ids, sizes = [], [], []
        for piece in slices(batches):
            for doc, text in zip(piece.column(0).to_pylist(), texts_of(piece), strict=True):
                keys = {k for line in text.split("\n") if (k := line_key(line, min_chars)) is not None}
                hashes.extend(map(_hash, keys))
                ids.append(doc)
                sizes.append(len(keys))
            if len(hashes) > ENTRIES_AT_ONCE:
                yield np.frombuffer(b"".join(hashes), dtype=_HASH), np.repeat(np.array(ids, np.int64), sizes)
                hashes, ids, sizes = [], [], []
        if hashes:
            yield np.frombuffer(b"".join(hashes), dtype=_HASH), np.repeat(np.array(ids, np.int64), sizes)

    def packed(place, kind, hashes, ids):
        cuts = _cuts(place)
        for begin in range(0, len(cuts) - 1, 256):
            ends = cuts[begin : begin + 257]
            spans = list(zip(ends[:-1], ends[1:], strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(place[ends[:-1]]),
                    pa.array([kind] * len(spans), pa.int32()),
                    pa.array([hashes[a:b].tobytes() for a, b in spans], pa.binary()),
                    pa.array([ids[a:b].tobytes() for a, b in spans], pa.binary()),
                ],
                names=["range", "kind", "hashes", "ids"],
            )

    def run(batches):
        for hashes, ids in gathered(batches):
            order = np.lexsort((ids, hashes["low"], hashes["high"]))
            hashes, ids = hashes[order], ids[order]
            first = np.concatenate([[True], hashes[1:] != hashes[:-1]])
            once = first | np.concatenate([[True], ids[1:] != ids[:-1]])  # rows of one id are one document
            hashes, ids, first = hashes[once], ids[once], first[once]
            group = np.cumsum(first) - 1
            several = np.bincount(group)[group] > 1
            place = ((hashes["high"] >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
            # hashes are sorted, so ranges are in order
            for kind, chosen in ((0, first & ~several), (1, first & several), (2, ~first)):
                yield from packed(place[chosen], kind, hashes[chosen], ids[chosen])

    ship(docs.sparkSession)
    return docs.mapInArrow(run, "range long, kind int, hashes binary, ids binary")


def _suspected(entries: DataFrame) -> DataFrame:
    """Hash and document of every key that the second filter of its range holds."""

    def run(table: pa.Table) -> pa.Table:
        hashes = np.frombuffer(b"".join(table["hashes"].to_pylist()), dtype=_HASH)
        ids = np.frombuffer(b"".join(table["ids"].to_pylist()), dtype=np.int64)
        sizes = [len(x) // _HASH.itemsize for x in table["hashes"].to_pylist()]
        known = np.repeat(table["kind"].to_numpy() == 1, sizes)
        once, again = Bloom(len(hashes)), Bloom(len(hashes))
        once.add(hashes["low"][known])
        again.add(hashes["low"][known])
        single = hashes["low"][~known]
        for begin in range(0, len(single), KEYS_AT_ONCE):
            keys, times = np.unique(single[begin : begin + KEYS_AT_ONCE], return_counts=True)
            again.add(keys[(times > 1) | once.holds(keys)])
            once.add(keys)
        found = again.holds(hashes["low"])
        hashes, ids = hashes[found], ids[found]
        return pa.Table.from_arrays(
            [pa.array(hashes["high"].view(np.int64)), pa.array(hashes["low"].view(np.int64)), pa.array(ids)],
            names=["high", "low", "doc_id"],
        )

    return entries.groupBy("range").applyInArrow(run, "high long, low long, doc_id long")


def _spread(entries: DataFrame) -> DataFrame:
    """The same rows from what a task knew to be shared, which needs no filter."""

    def run(batches):
        for batch in batches:
            for packed, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                hashes = np.frombuffer(packed, dtype=_HASH)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes["high"].view(np.int64)),
                        pa.array(hashes["low"].view(np.int64)),
                        pa.array(np.frombuffer(ids, dtype=np.int64)),
                    ],
                    names=["high", "low", "doc_id"],
                )

    return entries.select("hashes", "ids").mapInArrow(run, "high long, low long, doc_id long")


def _to_drop(suspects: DataFrame, min_docs: int) -> DataFrame:
    """doc_id and packed hashes of the lines it loses. Suspects are counted exactly; hot keys are added up map-side."""
    pairs = as_table(suspects.distinct(), "suspected_lines")
    shared = pairs.groupBy("high", "low").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
    verdicts = as_table(shared.where(F.col("n") >= min_docs).drop("n"), "shared_lines")
    if verdicts.count() <= BROADCAST_VERDICTS:
        verdicts = F.broadcast(verdicts)
    lost = pairs.join(verdicts, ["high", "low"]).where(F.col("doc_id") != F.col("keeper"))
    return lost.groupBy("doc_id").agg(F.collect_list(F.struct("high", "low")).alias("lost"))


def drop_shared_lines(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    entries_a_range: int = ENTRIES_A_RANGE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept (the text that is left) of every row.

    A key of ``min_chars`` or more code points in ``min_docs`` or more documents goes from all of them but the one with
    the largest id; all its lines stay there, however many. Null and empty texts are one empty line. Rows that share
    an id are one document, each with its own text. A row with a null id neither counts nor loses a line. An empty
    table gives none.
    """
    docs = id_and_text(docs, id_col, text_col)
    known = docs.where("doc_id is not null")
    # no document has more keys than its length allows
    most = known.agg(F.sum(F.floor(F.length("text") / (min_chars + 1)) + 1)).first()[0] or 0
    entries = as_table(_entries(known, 1 + most // entries_a_range, min_chars), "line_entries")
    suspects = _suspected(entries.where("kind < 2")).unionAll(_spread(entries.where("kind = 2")))
    lost = as_table(_to_drop(suspects, min_docs), "lost_lines")
    size = lost.agg(F.sum(F.size("lost") * _HASH.itemsize + 8)).first()[0] or 0
    rows = docs.join(F.broadcast(lost) if size <= BROADCAST_BYTES else lost, "doc_id", "left").select("doc_id", "text", "lost")

    def run(piece, texts):
        n_lines, n_dropped, kept = [], [], []
        for text, lost in zip(texts, piece.column(2), strict=True):
            lines = text.split("\n")
            stay = lines
            if lost.is_valid:
                high, low = (lost.values.field(k).to_numpy().view(np.uint64) for k in (0, 1))
                gone = set()
                for a, b in zip(high.tolist(), low.tolist(), strict=True):
                    gone.add(a.to_bytes(8, "little") + b.to_bytes(8, "little"))
                stay = [x for x in lines if (k := line_key(x, min_chars)) is None or _hash(k) not in gone]
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
            kept.append("\n".join(stay))
        return {"doc_id": piece.column(0), "n_lines": n_lines, "n_dropped": n_dropped, "kept": kept}

    return map_texts(rows, run, "doc_id long, n_lines long, n_dropped long, kept string")


def digests(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
