"""Benchmark items in documents, with a budget of edits, by the pigeonhole principle.

An item with a budget of k edits is cut into k + 1 pieces, one of which must occur unchanged. One pass of an
Aho-Corasick automaton finds all pieces. Around a hit, pieces are put together two by two: of the parts of a node
with n pieces and fewer than n edits, one has fewer edits than pieces, so a hit climbs from part to whole only while
each node is near enough, and most hits end at a cheap test. Distances are Myers' bit-parallel ones.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import SLICE_ROWS, id_and_text, map_texts, ship, slices, texts_of

#: Edits allowed for each character of a normalised item.
BUDGET = 0.1
#: Items with fewer normalised characters are searched as whole words and without edits: else they occur by chance.
LEAST_CHARS = 20
#: Items in one automaton; more are searched for in several passes over the documents.
ITEMS_AT_ONCE = 5_000

_GAPS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))
#: Scripts without a space between all words (South-East Asian, Chinese, Japanese, Korean): an item may begin anywhere.
_UNSPACED = re.compile("[\\u0e00-\\u0eff\\u1000-\\u11ff\\u1780-\\u17ff\\u2e80-\\u9fff\\ua960-\\ua97f\\uac00-\\ud7ff\\uf900-\\ufaff\\uff66-\\uffdc\\U00020000-\\U0003ffff]")
_OTHER_GAPS = re.compile("[ -¿ -⁯　-〿︰-﹯！-／]")


def normalised(text: str) -> str:
    """Lower case; runs of punctuation and white space are one space, none at the ends."""
    folded = text.lower()
    if not folded.isascii():
        folded = _OTHER_GAPS.sub(" ", folded)
    return b" ".join(folded.encode().translate(_GAPS).split()).decode()


def edit_distance(pattern: str, text: str) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to any part of ``text``, and where the first such part ends (Myers 1999)."""
    size = len(pattern)
    places: dict[str, int] = {}
    for i, c in enumerate(pattern):
        places[c] = places.get(c, 0) | 1 << i
    full, last = (1 << size) - 1, 1 << size >> 1
    rise, fall, score = full, 0, size
    best, at = size, 0
    get = places.get
    for j, c in enumerate(text):
        equal = get(c, 0)
        vertical = equal | fall
        across = (((equal & rise) + rise) ^ rise) | equal
        up, down = fall | (full & ~(across | rise)), rise & across
        if up & last:
            score += 1
        elif down & last:
            score -= 1
            if score < best:
                best, at = score, j + 1
        up, down = (up << 1) & full, (down << 1) & full
        rise, fall = down | (full & ~(vertical | up)), up & vertical
    return best, at


@dataclass
class Item:
    """A normalised item and its nodes: for each piece the ranges of pieces it is part of, from two up to all."""

    item_id: int
    text: str
    cuts: list[int]
    parts: list[list[tuple[int, int]]]
    as_words: bool = False

    @property
    def budget(self) -> int:
        return len(self.cuts) - 2


def cut(item_id: int, text: str, budget: float = BUDGET) -> Item:
    n = int(budget * len(text)) + 1
    cuts = [len(text) * i // n for i in range(n + 1)]
    parts: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    level = [(i, i + 1) for i in range(n)]
    while len(level) > 1:
        paired = [(level[i][0], level[min(i + 1, len(level) - 1)][1]) for i in range(0, len(level), 2)]
        for low, high in paired:
            for i in range(low, high):
                if not parts[i] or parts[i][-1] != (low, high):
                    parts[i].append((low, high))
        level = paired
    return Item(item_id, text, cuts, parts)


class Finder:
    """All pieces of all items in one automaton; items of under ``least`` characters are whole words without edits."""

    def __init__(self, items: list[tuple[int, str]], budget: float = BUDGET, least: int = 0):
        self.items = [cut(i, t, budget if len(t) >= least else 0) for i, t in items]
        for item in self.items:
            item.as_words = len(item.text) < least
        pieces: dict[str, list[tuple[int, int]]] = {}
        for k, item in enumerate(self.items):
            for i in range(len(item.cuts) - 1):
                pieces.setdefault(item.text[item.cuts[i] : item.cuts[i + 1]], []).append((k, i))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in pieces.items():
            self.automaton.add_word(piece, (len(piece), owners))
        if pieces:
            self.automaton.make_automaton()

    def find(self, text: str) -> dict[int, int]:
        """Item id -> least distance, for items within their budget of some part of the normalised ``text``."""
        best: dict[int, int] = {}
        seen: dict[int, list[tuple[int, int]]] = {}
        if not self.items or not text:
            return best
        for end, (size, owners) in self.automaton.iter(text):
            for k, i in owners:
                item = self.items[k]
                if best.get(item.item_id) == 0:
                    continue
                if item.as_words and not (_word_edge(text, end + 1 - size) and _word_edge(text, end + 1)):
                    continue
                offset = end + 1 - size - item.cuts[i]
                if any(low <= offset <= high for low, high in seen.get(k, ())):
                    continue
                if not self._climbs(item, i, offset, text):
                    continue
                room = 2 * item.budget
                seen.setdefault(k, []).append((offset - item.budget, offset + item.budget))
                distance, _ = edit_distance(item.text, text[max(0, offset - room) : max(0, offset + len(item.text) + room)])
                if distance <= item.budget:
                    best[item.item_id] = min(distance, best.get(item.item_id, distance))
        return best

    @staticmethod
    def _climbs(item: Item, i: int, offset: int, text: str) -> bool:
        """Whether each node above piece ``i``, but the whole item, has fewer edits than pieces near its place."""
        cuts = item.cuts
        for low, high in item.parts[i]:
            if high - low == len(cuts) - 1:
                return True
            allowed = high - low - 1
            part = item.text[cuts[low] : cuts[high]]
            begin, end = offset + cuts[low], offset + cuts[high]
            if text[max(0, begin) : max(0, end)] == part:
                continue
            if allowed == 1 and not _one_edit(item, i, low, high, offset, text):
                return False
            if edit_distance(part, text[max(0, begin - allowed) : max(0, end + allowed)])[0] > allowed:
                return False
        return True


def _word_edge(text: str, at: int) -> bool:
    """Whether a word may begin or end before character ``at`` of a normalised text."""
    around = text[max(0, at - 1) : at + 1]
    return len(around) < 2 or " " in around or bool(_UNSPACED.search(around))


def _one_edit(item: Item, i: int, low: int, high: int, offset: int, text: str) -> bool:
    """Cheap test: with one edit in the neighbour piece, one of its halves is unchanged, shifted by one at most."""
    other = high - 1 if i == low else low
    a, b = item.cuts[other], item.cuts[other + 1]
    middle = (a + b) // 2
    first, second = item.text[a:middle], item.text[middle:b]
    at = offset + a
    return any(text.startswith(first, max(0, at + d)) or text.startswith(second, max(0, at + middle - a + d)) for d in (0, -1, 1))


def contaminated(docs: DataFrame, items: DataFrame, budget: float = BUDGET, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, distance and budget: the least edit distance of each item found in each document.

    Both texts are normalised first; an item counts as found within ``budget`` edits a character. Null and empty
    texts hold nothing. Items of under ``LEAST_CHARS`` characters are searched as whole words with a budget of 0; only
    those that ``unsearchable`` returns are not searched. Rows that repeat an id are searched one by one and give a
    result each; items that repeat an id give its least distance.
    """
    ship(docs.sparkSession)
    rows = id_and_text(docs, id_col, text_col)
    wanted = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).where("item_id is not null and text is not null").distinct()
    blocks = -(-wanted.count() // ITEMS_AT_ONCE)
    found = None
    for block in range(max(blocks, 1)):
        own = wanted.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1))) == block)
        part = _searched(rows, [(r["item_id"], r["text"]) for r in own.collect()], budget)  # about ITEMS_AT_ONCE items
        found = part if found is None else found.unionAll(part)
    return found


def unsearchable(items: DataFrame, item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id of the items that are not searched: those of null id, and those without a letter or digit."""

    def run(piece, texts):
        return {"item_id": piece.column(0), "empty": [not normalised(t) for t in texts]}

    return map_texts(id_and_text(items, item_col, item_text_col), run, "item_id long, empty boolean").where("item_id is null or empty").select("item_id")


def _searched(rows: DataFrame, items: list[tuple[int, str]], budget: float) -> DataFrame:
    named = sorted({(i, normalised(t)) for i, t in items})
    sent = rows.sparkSession.sparkContext.broadcast([(i, t) for i, t in named if t])
    least = LEAST_CHARS
    limits: dict[int, int] = {}
    for i, t in named:
        limits[i] = max(limits.get(i, 0), int(budget * len(t)) if len(t) >= least else 0)

    def run(batches):
        finder = Finder(sent.value, budget, least)
        for piece in slices(batches):
            out = []
            for doc_id, text in zip(piece.column(0).to_pylist(), texts_of(piece), strict=True):
                out += [(doc_id, item, distance, limits[item]) for item, distance in sorted(finder.find(normalised(text)).items())]
            for begin in range(0, len(out), SLICE_ROWS):
                doc, item, distance, limit = zip(*out[begin : begin + SLICE_ROWS], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64()), pa.array(item, pa.int64()), pa.array(distance, pa.int32()), pa.array(limit, pa.int32())],
                    names=["doc_id", "item_id", "distance", "budget"],
                )

    return rows.mapInArrow(run, "doc_id long, item_id long, distance int, budget int")
