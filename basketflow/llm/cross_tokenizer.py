"""Alignment of two tokenizers' tokens, document by document, by fragments that compose.

Where tokens of both end at the same byte, the text is cut into groups. A range of bytes of a document, taken by itself,
gives a fragment: the tokens up to its first common end (open prefix), the groups between its common ends (closed) and the
tokens after the last one (open suffix). Two neighbours compose: the suffix of the left one and the prefix of the right
one become a group. That is associative, so the fragments of a long document are made by many tasks and reduced as a
tree; ordinary documents are one fragment of one task.

Inside a group each stretch between two neighbouring ends, of whichever tokenizer, is the overlap of exactly one token
of either, and every overlap is one stretch: links need no comparison of tokens. How often a pair of ids is linked in the
corpus is added up in the tasks first. Pairs with more than one link in ``RARE`` are few, and are broadcast; the others,
of which none is frequent, are joined.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.byte_bpe import codec
from basketflow.llm.common import arrow_types, id_and_text, ship, slices, texts_of
from basketflow.shared import as_table

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Characters from which a document is shared out between tasks, and characters of a share (longer without a space).
LONG_CHARS, SHARE_CHARS = 400_000, 100_000
#: Bytes of a fragment before it meets its neighbours, and neighbours that a task of the tree composes.
RANGE_BYTES, FAN_IN = 65_536, 8
#: Pairs with more than one in so many of all links are broadcast, so there are at most as many; 24 bytes each.
RARE = 1 << 20
#: Distinct pairs that a task adds up before it sends them.
PAIRS_AT_ONCE = 1_000_000

_SPACE = "▁"
_EMPTY = np.zeros(0, np.int32)

Counts = tuple[np.ndarray, np.ndarray]


class Merges:
    """A byte-level BPE file of the tokenizers library, encoded by its merges in order of their ids."""

    def __init__(self, path: str):
        own = codec(path)
        self.tokens, self._slow = own.tokens, own.encode
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        order = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        ranks = {t: i for i, t in enumerate(self.tokens) if t}
        # ids that rise with the merges are ranks, which the faster library takes
        as_ranks = order == sorted(order) and all(bytes([b]) in ranks for b in range(256)) and len(ranks) == 256 + len(order)
        self._fast = tiktoken.Encoding("merges", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}) if as_ranks else None

    def encode(self, text: str) -> np.ndarray:
        return self._slow(text) if self._fast is None else np.array(self._fast.encode_ordinary(text), dtype=np.int32)


@lru_cache(maxsize=2)
def merges(path: str | None) -> Merges:
    return Merges(path or public_tokenizers.path(VOCABULARY_A))


class Pieces:
    """A SentencePiece vocabulary."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.vocab_size())]
        self.tokens = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(names)]
        self._encode, self._space = model.encode, [model.piece_to_id(_SPACE)]
        #: No piece goes on past a word's end, so a text may be cut there.
        self.ends_words = not any(_SPACE in p.lstrip(_SPACE) for p in names)

    def encode(self, spaced: str) -> np.ndarray | None:
        """Ids of a text that begins with a space (which the library would add), None if they do not spell it."""
        ids = self._encode(spaced[1:]) if len(spaced) > 1 else self._space
        spelt = b"".join(map(self.tokens.__getitem__, ids)) == spaced.encode()
        return np.array(ids, dtype=np.int32) if spelt else None


@lru_cache(maxsize=2)
def pieces(path: str | None) -> Pieces:
    return Pieces(path or public_tokenizers.path(VOCABULARY_B))


@dataclass
class Aligned:
    """Where groups end, ``a1,a2|b1;`` of each group token by token, and links: pair of ids and where the overlap ends."""

    common: np.ndarray
    parts: list[bytes]
    pairs: np.ndarray
    ends: np.ndarray


class Pair:
    """Both tokenizers: ids of a text, lengths of tokens, and their decimal ids with what may follow them."""

    def __init__(self, path_a: str | None, path_b: str | None):
        self._a, self._b = merges(path_a), pieces(path_b)
        self.size_a, self.size_b = (np.array([len(t) for t in x.tokens], dtype=np.int64) for x in (self._a, self._b))
        self.width = len(self.size_b)
        self._a_more, self._a_last = self._names(self.size_a, b",", b"|")
        self._b_more, self._b_last = self._names(self.size_b, b",", b";")

    @staticmethod
    def _names(sizes: np.ndarray, *ends: bytes) -> list[np.ndarray]:
        return [np.array([b"%d%s" % (i, end) for i in range(len(sizes))], dtype=object) for end in ends]

    def encode(self, spaced: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of either tokenizer, None if one of them does not spell the text."""
        b = self._b.encode(spaced)
        if b is None:
            return None
        a = self._a.encode(spaced)
        # a byte-level tokenizer may leave bytes out, but never changes them
        return (a, b) if self.size_a[a].sum() == self.size_b[b].sum() else None

    def aligned(self, a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray) -> Aligned:
        """Tokens that begin together at the byte 0 and end together. Bytes are marked, so that nothing is sorted."""
        here_a, here_b = (np.zeros(int(end_a[-1]) + 1, dtype=bool) for _ in range(2))
        here_a[end_a], here_b[end_b] = True, True
        common = here_a & here_b
        ends = np.flatnonzero(here_a | here_b)
        # how many tokens, or groups, end up to each byte
        upto_a, upto_b, upto = (np.cumsum(x, dtype=np.int32) for x in (here_a, here_b, common))
        pairs = a[upto_a[ends - 1]].astype(np.int64) * self.width + b[upto_b[ends - 1]]
        last_a, last_b = common[end_a], common[end_b]
        group_a, group_b = upto[end_a - 1], upto[end_b - 1]
        until_a, until_b = (np.append(0, np.flatnonzero(x) + 1) for x in (last_a, last_b))
        parts = np.empty(len(a) + len(b), dtype=object)
        parts[np.arange(len(a)) + until_b[group_a]] = np.where(last_a, self._a_last[a], self._a_more[a])
        parts[np.arange(len(b)) + until_a[group_b + 1]] = np.where(last_b, self._b_last[b], self._b_more[b])
        return Aligned(np.flatnonzero(common), parts.tolist(), pairs, ends)


@lru_cache(maxsize=2)
def pair_of(path_a: str | None, path_b: str | None) -> Pair:
    return Pair(path_a, path_b)


@dataclass
class Fragment:
    """Tokens of some bytes of a document. Without a common end there is only the prefix."""

    prefix: tuple[np.ndarray, np.ndarray] = (_EMPTY, _EMPTY)
    #: None where no common end lies in the bytes
    suffix: tuple[np.ndarray, np.ndarray] | None = None
    n_groups: int = 0
    text: bytes = b""
    #: pairs that are linked in the closed groups and the number of links of each; a pair may occur again
    links: tuple[Counts, ...] = ()

    def then(self, other: Fragment, pair: Pair) -> Fragment:
        """Both, one after the other."""
        if self.suffix is None:
            return Fragment(_joined(self.prefix, other.prefix), other.suffix, other.n_groups, other.text, other.links)
        middle = _joined(self.suffix, other.prefix)
        if other.suffix is None:
            return Fragment(self.prefix, middle, self.n_groups, self.text, self.links)
        if not len(middle[0]):  # both ends of the bytes are common ends
            return Fragment(self.prefix, other.suffix, self.n_groups + other.n_groups, self.text + other.text, self.links + other.links)
        closed = _closed(*middle, pair)
        return Fragment(
            self.prefix,
            other.suffix,
            self.n_groups + closed.n_groups + other.n_groups,
            self.text + closed.text + other.text,
            self.links + closed.links + other.links,
        )


#: The common end before the first token.
START = Fragment(suffix=(_EMPTY, _EMPTY))


def _counted(found: np.ndarray, times: np.ndarray | None = None) -> Counts:
    """Distinct pairs and how often each is there."""
    if times is None:
        return np.unique(found, return_counts=True)
    pairs, inverse = np.unique(found, return_inverse=True)
    return pairs, np.bincount(inverse, times, len(pairs)).astype(np.int64)


def _merged(links: Sequence[Counts]) -> Counts:
    if len(links) == 1:
        return links[0]
    return _counted(*(np.concatenate(x) for x in zip(*links, strict=True))) if links else (np.zeros(0, np.int64),) * 2


def _joined(left, right):
    return tuple(np.concatenate(x) if len(x[0]) and len(x[1]) else x[0] if len(x[0]) else x[1] for x in zip(left, right, strict=True))


def _closed(a: np.ndarray, b: np.ndarray, pair: Pair) -> Fragment:
    """Tokens that begin and end together."""
    found = pair.aligned(a, b, np.cumsum(pair.size_a[a]), np.cumsum(pair.size_b[b]))
    return Fragment((_EMPTY, _EMPTY), (_EMPTY, _EMPTY), len(found.common), b"".join(found.parts), (_counted(found.pairs),))


def fragment(a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray, pair: Pair) -> Fragment:
    """Of tokens whose ends lie in a range of bytes; where the first ones begin need not be known."""
    common = np.intersect1d(end_a, end_b, assume_unique=True)
    if not len(common):
        return Fragment((a, b))
    (from_a, to_a), (from_b, to_b) = (np.searchsorted(x, common[[0, -1]], "right") for x in (end_a, end_b))
    prefix, suffix = (a[:from_a], b[:from_b]), (a[to_a:], b[to_b:])
    if from_a == to_a:
        return Fragment(prefix, suffix)
    closed = _closed(a[from_a:to_a], b[from_b:to_b], pair)
    return Fragment(prefix, suffix, closed.n_groups, closed.text, closed.links)


def fragments(a: np.ndarray, b: np.ndarray, pair: Pair, size: int = RANGE_BYTES) -> Iterator[Fragment]:
    """One for each range of ``size`` bytes."""
    end_a, end_b = np.cumsum(pair.size_a[a]), np.cumsum(pair.size_b[b])
    edges = range(size, max(end_a[-1:].sum(), end_b[-1:].sum()) + size, size)
    at_a, at_b = (np.concatenate([[0], np.searchsorted(x, edges, "right")]) for x in (end_a, end_b))
    for k in range(len(edges)):
        in_a, in_b = slice(at_a[k], at_a[k + 1]), slice(at_b[k], at_b[k + 1])
        yield fragment(a[in_a], b[in_b], end_a[in_a], end_b[in_b], pair)


def composed(parts: Iterable[Fragment], pair: Pair) -> Fragment:
    """Neighbours two by two, until one is left: no part is copied more often than the tree is deep."""
    parts = list(parts)
    while len(parts) > 1:
        parts = [p[0].then(p[1], pair) if len(p) > 1 else p[0] for p in (parts[i : i + 2] for i in range(0, len(parts), 2))]
    return parts[0] if parts else Fragment()


def cut_points(text: str, size: int = SHARE_CHARS) -> list[int]:
    """Begins of shares of about ``size`` characters. Each but the first starts with a space after a character that is
    none (nor white space), where both tokenizers begin a token whatever is before; where no such place is, shares grow."""
    begins, at = [0], size
    place = re.compile(r"(?<=\S) ")
    while at < len(text) and (found := place.search(text, at)):
        begins.append(found.start())
        at = found.start() + size
    return begins


_PAIRS = "pairs binary, times binary"
#: What is known of a row after its fragments have met: no pairs yet looked up.
_ROW = f"row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, {_PAIRS}"
_PART = f"row long, doc_id long, seq int, valid boolean, n_a long, n_b long, n_groups long, groups binary, {_PAIRS}, open array<array<int>>"


def _row(row, doc_id, n_a, n_b, whole: Fragment) -> tuple:
    pairs, times = _merged(whole.links)
    return (
        row, doc_id, n_a, n_b, whole.n_groups, int(times.sum()),
        hashlib.sha256(whole.text[:-1]).hexdigest(), pairs.astype(np.int64).tobytes(), times.astype(np.int32).tobytes(),
    )


def _no_tokens(row, doc_id) -> tuple:
    return (row, doc_id, 0, 0, 0, 0, "", b"", b"")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _many(piece: list[tuple], pair: Pair) -> list[tuple]:
    """Whole documents, (row, doc_id, text): their tokens are one stream, and the ends of documents are common ends."""
    done, held = [], []
    for row, doc_id, text in piece:
        ids = pair.encode(" " + text) if text else None
        if ids is None:
            done.append(_no_tokens(row, doc_id))
        else:
            held.append((row, doc_id, *ids))
    if not held:
        return done
    a, b = (np.concatenate([x[k] for x in held]) for k in (2, 3))
    end_a, end_b = np.cumsum(pair.size_a[a]), np.cumsum(pair.size_b[b])
    found = pair.aligned(a, b, end_a, end_b)
    until_a, until_b = (np.cumsum([len(x[k]) for x in held]) for k in (2, 3))
    until_group = np.searchsorted(found.common, end_a[until_a - 1], "right")
    until_link = np.searchsorted(found.ends, end_a[until_a - 1], "right")
    begin_a = begin_b = begin_group = begin_link = 0
    for k, (row, doc_id, *_) in enumerate(held):
        text = b"".join(found.parts[begin_a + begin_b : until_a[k] + until_b[k]])
        whole = Fragment(n_groups=int(until_group[k] - begin_group), text=text, links=(_counted(found.pairs[begin_link : until_link[k]]),))
        done.append(_row(row, doc_id, int(until_a[k] - begin_a), int(until_b[k] - begin_b), whole))
        begin_a, begin_b, begin_group, begin_link = until_a[k], until_b[k], until_group[k], until_link[k]
    return done


def _ordinary(docs: DataFrame, path_a: str | None, path_b: str | None) -> DataFrame:
    schema = arrow_types(_ROW)

    def run(batches):
        pair = pair_of(path_a, path_b)
        for piece in slices(batches, 2):
            rows = zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), texts_of(piece, 2), strict=True)
            yield _batch(_many(list(rows), pair), schema)

    return docs.mapInArrow(run, _ROW)


def _part(row, doc_id, seq, valid, n_a, n_b, whole: Fragment) -> tuple:
    pairs, times = _merged(whole.links)
    ends = (*whole.prefix, *(whole.suffix or ()))
    return (
        row, doc_id, seq, valid, n_a, n_b, whole.n_groups, whole.text,
        pairs.astype(np.int64).tobytes(), times.astype(np.int32).tobytes(), [x.tolist() for x in ends],
    )


def _from_part(part: dict) -> Fragment:
    ends = [np.array(x, dtype=np.int32) for x in part["open"]]
    links = np.frombuffer(part["pairs"], np.int64), np.frombuffer(part["times"], np.int32)
    return Fragment(tuple(ends[:2]), tuple(ends[2:]) or None, part["n_groups"], part["groups"], (links,))


def _shared_out(docs: DataFrame, path_a: str | None, path_b: str | None, share: int, size: int) -> DataFrame:
    """Long documents: shares of the text go to tasks of their own, and their fragments are reduced level by level."""

    share_row = "row long, doc_id long, seq int, text string"
    share_schema, part_schema, row_schema = (arrow_types(x) for x in (share_row, _PART, _ROW))

    def cut(batches):
        ends_words = pieces(path_b).ends_words
        for batch in batches:
            for row, doc_id, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                begins = cut_points(text, share) if ends_words else [0]
                for seq, (begin, end) in enumerate(zip(begins, [*begins[1:], len(text)], strict=True)):
                    yield _batch([(row, doc_id, seq, text[begin:end])], share_schema)

    def encoded(batches):
        pair = pair_of(path_a, path_b)
        for piece in slices(batches, 3):
            rows = []
            for row, doc_id, seq, text in zip(*(piece.column(k).to_pylist() for k in range(4)), strict=True):
                ids = pair.encode(" " + text if seq == 0 else text)
                if ids is None:
                    rows.append(_part(row, doc_id, seq, False, 0, 0, Fragment()))
                else:
                    rows.append(_part(row, doc_id, seq, True, len(ids[0]), len(ids[1]), composed(fragments(*ids, pair, size), pair)))
            yield _batch(rows, part_schema)

    def meet(table: pa.Table) -> pa.Table:
        parts = sorted(table.to_pylist(), key=lambda x: x["seq"])
        first = parts[0]
        valid = all(x["valid"] for x in parts)
        pair = pair_of(path_a, path_b)
        whole = composed(map(_from_part, parts), pair) if valid else Fragment()
        sums = [sum(x[n] for x in parts) for n in ("n_a", "n_b")]
        row = _part(first["row"], first["doc_id"], first["seq"] // FAN_IN, valid, *sums, whole)
        return pa.Table.from_batches([_batch([row], part_schema)])

    def close(batches):
        pair = pair_of(path_a, path_b)
        for batch in batches:
            rows = []
            for part in batch.to_pylist():
                if part["valid"]:
                    rows.append(_row(part["row"], part["doc_id"], part["n_a"], part["n_b"], START.then(_from_part(part), pair)))
                else:
                    rows.append(_no_tokens(part["row"], part["doc_id"]))
            yield _batch(rows, row_schema)

    spread = docs.mapInArrow(cut, share_row).repartition("row", "seq")
    parts = as_table(spread.mapInArrow(encoded, _PART), "fragments")
    most = parts.agg(F.max("seq")).first()[0] or 0
    while most:
        met = parts.groupBy("row", F.floor(F.col("seq") / FAN_IN).alias("up")).applyInArrow(meet, _PART)
        parts, most = as_table(met, "fragments"), most // FAN_IN
    return parts.mapInArrow(close, _ROW)


def _corpus_counts(rows: DataFrame, width: int) -> DataFrame:
    """pair, n (its links in the corpus) and best (no pair with the same id of the second tokenizer has more)."""
    schema = "pair long, n long"

    def run(batches):
        pairs, times, size = [], [], 0

        def added() -> Counts:
            return _counted(np.concatenate(pairs), np.concatenate(times))

        for batch in batches:
            for found, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                pairs.append(np.frombuffer(found, np.int64))
                times.append(np.frombuffer(n, np.int32).astype(np.int64))
                size += len(pairs[-1])
            if size > 4 * PAIRS_AT_ONCE:
                found, n = added()
                if len(found) > PAIRS_AT_ONCE:
                    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["pair", "n"])
                    pairs, times, size = [], [], 0
                else:
                    pairs, times, size = [found], [n], len(found)
        if size:
            found, n = added()
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["pair", "n"])

    counts = rows.select("pairs", "times").mapInArrow(run, schema).groupBy("pair").agg(F.sum("n").alias("n"))
    counts = as_table(counts, "pair_counts")
    of_b = counts.groupBy((F.col("pair") % width).alias("b")).agg(F.max("n").alias("most"))
    return counts.join(of_b, F.col("pair") % width == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


_FOUND = "row long, n_best long, count_sum long, rare array<long>, rare_times array<int>"


def _looked_up(rows: DataFrame, common: pa.Table) -> DataFrame:
    """For each row the sums over its common pairs, and its rare pairs."""
    spark = rows.sparkSession
    common = common.sort_by("pair")
    sent = spark.sparkContext.broadcast(tuple(common[n].to_numpy() for n in ("pair", "n", "best")))
    schema = arrow_types(_FOUND)

    def run(batches):
        known, count, best = sent.value
        for batch in batches:
            packed = [batch.column(k).to_pylist() for k in (1, 2)]
            sizes = np.array([len(x) // 4 for x in packed[1]], dtype=np.int64)
            pairs, times = np.frombuffer(b"".join(packed[0]), np.int64), np.frombuffer(b"".join(packed[1]), np.int32)
            at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
            hit = known[at] == pairs if len(known) else np.zeros(len(pairs), dtype=bool)
            ends = np.cumsum(sizes)

            def summed(values, ends=ends, sizes=sizes):
                total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
                return total[ends] - total[ends - sizes]

            n = np.where(hit, count[at] if len(known) else 0, 0)
            is_best = np.where(hit, best[at] if len(known) else False, False)
            rare = np.concatenate([[0], np.cumsum(summed(~hit))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(summed(times * is_best)),
                    pa.array(summed(times * n)),
                    pa.ListArray.from_arrays(rare, pa.array(pairs[~hit])),
                    pa.ListArray.from_arrays(rare, pa.array(times[~hit])),
                ],
                schema=schema,
            )

    return rows.select("row", "pairs", "times").mapInArrow(run, _FOUND)


def align(
    docs: DataFrame,
    vocabulary_a: str | None = None,
    vocabulary_b: str | None = None,
    long_chars: int = LONG_CHARS,
    share_chars: int = SHARE_CHARS,
    range_bytes: int = RANGE_BYTES,
    rare: int = RARE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row, and packed its linked
    pairs of ids (``a * size of the second vocabulary + b``) with the number of links of each.

    The vocabularies are paths, the same on every executor: a byte-level BPE file of the tokenizers library, and a
    SentencePiece model that adds a space. Null and empty texts, and those that one of the tokenizers does not spell
    byte by byte, have no tokens: zeros, no pairs, and no digest. Rows that repeat an id or have none are rows like
    others, and copies count in the corpus as often as they occur. An empty table gives none.
    """
    spark = docs.sparkSession
    ship(spark)
    numbered = id_and_text(docs, id_col, text_col).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    is_long = F.length("text") > long_chars
    rows = as_table(_ordinary(numbered.where(F.coalesce(~is_long, F.lit(True))), vocabulary_a, vocabulary_b), "aligned")
    # numbers of rows hold for one run only, so these are stored, and negative to be others than those above
    long = as_table(numbered.where(is_long).withColumn("row", -1 - F.col("row")), "long_texts")
    if not long.isEmpty():
        rows = rows.unionAll(as_table(_shared_out(long, vocabulary_a, vocabulary_b, share_chars, range_bytes), "aligned_long"))
    width = len(pieces(vocabulary_b).tokens)
    counts = as_table(_corpus_counts(rows, width), "pair_counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    common = F.col("n") > total // rare
    found = as_table(_looked_up(rows, counts.where(common).toArrow()), "looked_up")
    seldom = (
        found.where(F.size("rare") > 0)
        .select("row", F.explode(F.arrays_zip("rare", "rare_times")).alias("p"))
        .select("row", F.col("p.rare").alias("pair"), F.col("p.rare_times").cast("long").alias("times"))
        .join(counts.where(~common), "pair")
        .select("row", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    )
    sums = found.select("row", "n_best", "count_sum").unionAll(seldom).groupBy("row").agg(*(F.sum(n).alias(n) for n in ("n_best", "count_sum")))
    return rows.join(sums, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "pairs", "times"
    )


def digests(aligned: DataFrame) -> DataFrame:
    return aligned.drop("pairs", "times")
