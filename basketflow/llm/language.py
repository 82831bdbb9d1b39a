"""Language of texts by a linear-chain conditional random field over their words.

Each word is a node. Its features are hashed: affixes (two and three bytes at either end), inner three- and
four-byte grams, and the whole word as lexicon entry. Transitions are learned too, on chains of several documents
laid end to end, so that a chain may switch language. A text's language is the one with the largest mean marginal.

Marginals only compare the learned languages with each other. Whether a text is in any of them is judged by how many of
its letter sequences the learned texts have, of whichever language, against the share that more text of the same
kind would have (Good and Turing: all but the part of sequences that only one text has).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.chains import Steps
from basketflow.llm.common import extend_texts, fold, free_name, id_and_text, map_texts, stretch
from basketflow.shared import as_table

UNDETERMINED = "und"
BITS = 16
KINDS = 4
#: Up to so many languages have the full sample; beyond, the sample shrinks to no fewer documents than these.
FULL_SAMPLES, LEAST_SAMPLE = 64, 20
#: The feature row that never has a weight.
NOTHING = KINDS << BITS
#: Slots for the letter sequences of the learned texts.
SEQUENCE_BITS = 22
#: Part of the letter sequences that a text must share with the learned texts, of the part that these share.
LEAST_FAMILIAR = 0.4
#: Sequences of learned texts that count as few.
FEW_SEQUENCES = 1_000


def _letters() -> np.ndarray:
    """Byte -> its lower-case form if it is a letter's, else 0; all bytes of other scripts count as letters."""
    table = np.zeros(256, dtype=np.uint8)
    table[0x80:] = np.arange(0x80, 0x100)
    table[0x61:0x7B] = np.arange(0x61, 0x7B)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


_LETTER = _letters()


@dataclass
class Words:
    """Words of several texts: how many each text has, how long they are, and their features' rows."""

    counts: np.ndarray
    sizes: np.ndarray
    grams: list[np.ndarray]  # a feature row for each byte of each word
    whole: list[np.ndarray]  # a feature row for each word
    sequences: np.ndarray  # a slot for each byte of each word: it and its neighbours

    @property
    def begins(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes


def _mixed(values: np.ndarray, kind: int) -> np.ndarray:
    h = (values + np.uint64(kind + 1)) * np.uint64(0x9E3779B97F4A7C15)
    return ((h >> np.uint64(64 - BITS)) + np.uint64(kind << BITS)).astype(np.int64)


def words_of(texts: list[str]) -> Words:
    """Words are runs of letters. Whole texts are read at once; a zero byte stands around each."""
    raw = [t.lower().encode() for t in texts]
    joined = np.frombuffer(b"\0\0\0" + b"\0".join(raw) + b"\0\0\0", dtype=np.uint8)
    b = _LETTER[joined]
    inside = b != 0
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    begins, ends = change[0::2], change[1::2]
    text_ends = np.cumsum([len(r) + 1 for r in raw]) + 3
    counts = np.diff(np.concatenate([[0], np.searchsorted(begins, text_ends)]))
    sizes = ends - begins
    at = np.flatnonzero(inside)
    w = b.astype(np.uint64)
    three = w[at - 1] | w[at] << np.uint64(8) | w[at + 1] << np.uint64(16)
    four = np.where(w[at - 1] > 0, w[at - 2] << np.uint64(24) | three, np.uint64(0))
    position = at - np.repeat(begins, sizes)
    powers = np.cumprod(np.full(int(sizes.max(initial=0)), 0x100000001B3, dtype=np.uint64)) if len(sizes) else np.zeros(0, np.uint64)
    whole = np.add.reduceat(w[at] * powers[position], np.cumsum(sizes) - sizes) if len(sizes) else np.zeros(0, np.uint64)
    prefix = w[begins] | w[begins + 1] << np.uint64(8) | np.where(w[begins + 1] > 0, w[np.minimum(begins + 2, len(w) - 1)], 0).astype(np.uint64) << np.uint64(16)
    suffix = w[ends - 1] | w[ends - 2] << np.uint64(8) | np.where(w[ends - 2] > 0, w[ends - 3], 0).astype(np.uint64) << np.uint64(16) | np.uint64(1 << 30)
    grams = [_mixed(three, 0), np.where(four > 0, _mixed(four, 1), NOTHING)]
    inner = np.where(four > 0, four | np.uint64(1 << 40), three)
    sequences = (inner * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SEQUENCE_BITS)).astype(np.int64)
    return Words(counts, sizes, grams, [_mixed(prefix, 2), _mixed(suffix, 2), _mixed(whole, 3)], sequences)


def _sums(words: Words, weights: np.ndarray) -> np.ndarray:
    """Score of each word and label: the sum of its features' weights."""
    if not len(words.sizes):
        return np.zeros((0, weights.shape[1]))
    by_byte = weights[words.grams[0]]
    by_byte += weights[words.grams[1]]
    scores = np.add.reduceat(by_byte, words.begins, axis=0)
    for rows in words.whole:
        scores += weights[rows]
    return scores.astype(np.float64)


@dataclass
class Crf:
    labels: list[str]
    weights: np.ndarray
    moves: np.ndarray
    #: Which letter sequences the learned texts have, and how much of other texts of their kind these are.
    seen: np.ndarray = field(default_factory=lambda: np.zeros(1 << SEQUENCE_BITS, dtype=bool))
    usual: float = 1.0

    def marginals(self, words: Words, chains: np.ndarray) -> np.ndarray:
        """Probability of each label at each word, by forward-backward over the chains."""
        steps = Steps(chains)
        scores = _sums(words, self.weights)
        emit = np.empty_like(scores)
        emit[steps.place] = np.exp(np.clip(scores - scores.max(axis=1, keepdims=True), -40, 0))
        move = np.exp(self.moves)
        start = np.full(len(self.labels), 1 / len(self.labels))
        forward, scales = steps.forward(start, move, emit)
        both = forward * steps.backward(move, emit, scales)
        both /= both.sum(axis=1, keepdims=True)
        return both[steps.place]

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language of each text and the mean marginal of that language."""
        return self.judged(texts)[:2]

    def judged(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """As ``predict``, and how familiar the letters are: 1 for texts like the learned ones, 0 for other scripts."""
        words = words_of(texts)
        given = np.array([x > 0 and (any("a" <= c <= "z" for c in t[:200].lower()) or any(map(str.isalpha, t))) for x, t in zip(words.counts, texts, strict=True)])
        shares, familiar = np.full((len(texts), len(self.labels)), 0.0), np.zeros(len(texts))
        if len(words.sizes):
            marginals = self.marginals(words, words.counts) * words.sizes[:, None]
            text = np.repeat(np.arange(len(texts)), words.counts)
            for k in range(len(self.labels)):
                shares[:, k] = np.bincount(text, marginals[:, k], len(texts))
            familiar = np.bincount(np.repeat(text, words.sizes), self.seen[words.sequences], len(texts))
        total = shares.sum(axis=1)
        best = shares.argmax(axis=1)
        score = np.where(given, shares.max(axis=1) / np.maximum(total, 1e-300), 0.0)
        familiar = np.where(given, familiar / np.maximum(total * self.usual, 1e-300), 0.0)
        return [self.labels[k] if ok else UNDETERMINED for k, ok in zip(best, given, strict=True)], np.clip(score, 0, 1), np.clip(familiar, 0, 1)


def _sequences(texts: list[str]) -> tuple[np.ndarray, float]:
    """Which slots the texts fill, and the part of a further text that is expected in them.

    A text counts once for each sequence, however often it repeats it. With few texts hardly anything is expected, so that
    nothing is foreign to them.
    """
    words = words_of(texts)
    text = np.repeat(np.repeat(np.arange(len(texts)), words.counts), words.sizes)
    slots = np.unique(text << SEQUENCE_BITS | words.sequences) & ((1 << SEQUENCE_BITS) - 1)
    counts = np.bincount(slots, minlength=1 << SEQUENCE_BITS)
    return counts > 0, max(len(slots) - int((counts == 1).sum()), 1) / (len(slots) + FEW_SEQUENCES)


def train(
    texts: list[str], langs: list[str], epochs: int = 3, together: int = 3, batch: int = 24, rate: float = 0.15, seed: int = 7
) -> Crf:
    """Maximise the chains' conditional likelihood by adaptive gradient steps over small batches of chains."""
    labels = sorted(set(langs))
    index = {name: k for k, name in enumerate(labels)}
    size = (NOTHING + 1, len(labels))
    crf = Crf(labels, np.zeros(size, np.float32), np.eye(len(labels)), *_sequences(texts))
    squares, move_squares = np.full(size, 1e-2), np.full_like(crf.moves, 1e-2)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for begin in range(0, len(order), batch):
            picked = order[begin : begin + batch]
            words = words_of([texts[i] for i in picked])
            if not len(words.sizes):
                continue
            truth = np.repeat([index[langs[i]] for i in picked], words.counts)
            chains = np.add.reduceat(words.counts, np.arange(0, len(picked), together))
            _step(crf, words, truth, chains, squares, move_squares, rate)
    return crf


def _step(crf: Crf, words: Words, truth: np.ndarray, chains: np.ndarray, squares: np.ndarray, move_squares: np.ndarray, rate: float) -> None:
    steps = Steps(chains)
    n, labels = len(truth), len(crf.labels)
    scores = _sums(words, crf.weights)
    emit = np.empty_like(scores)
    emit[steps.place] = np.exp(np.clip(scores - scores.max(axis=1, keepdims=True), -40, 0))
    move = np.exp(crf.moves)
    forward, scales = steps.forward(np.full(labels, 1 / labels), move, emit)
    backward = steps.backward(move, emit, scales)
    marginals = (forward * backward)[steps.place]
    marginals /= marginals.sum(axis=1, keepdims=True)
    error = -marginals
    error[np.arange(n), truth] += 1
    first = np.zeros(n, dtype=bool)
    first[(np.cumsum(chains) - chains)[chains > 0]] = True
    later = np.flatnonzero(~first)
    into = (emit * backward / scales[:, None])[steps.place[later]]
    expected = forward[steps.place[later - 1]].T @ into * move
    seen = np.zeros_like(move)
    np.add.at(seen, (truth[later - 1], truth[later]), 1)
    rows = np.concatenate([*words.grams, *words.whole])
    word = np.repeat(np.arange(n), words.sizes)
    for k in range(labels):
        own, by_byte = error[:, k], error[word, k]
        slope = np.bincount(rows, np.concatenate([by_byte, by_byte, own, own, own]), NOTHING + 1) / len(chains)
        slope[NOTHING] = 0
        squares[:, k] += slope**2
        crf.weights[:, k] += rate * slope / np.sqrt(squares[:, k])
    slope = (seen - expected) / len(chains)
    move_squares += slope**2
    crf.moves += rate * slope / np.sqrt(move_squares)


def fit(docs: DataFrame, per_lang: int = 300, max_chars: int = 6_000, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> Crf:
    """Train on ``per_lang`` documents of every language, drawn by a hash of id and text among texts of any length.

    A text of over ``max_chars`` characters gives so many of them, from a place that the hash chooses. Every
    label with a text that is not empty is learned. With more than ``FULL_SAMPLES`` languages each gets fewer
    documents, but ``LEAST_SAMPLE`` in any case; equal rows count once. The driver gets at most that many texts of
    ``max_chars`` characters, and holds 3 MB of weights a language.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    usable = rows.where(F.col("lang").isNotNull() & (F.length("text") > 0)).withColumn("at", F.xxhash64("doc_id", "text"))
    keys = as_table(usable.select("lang", "at").distinct(), "keys")
    counts = keys.groupBy("lang").count().collect()
    if not counts:
        return Crf([UNDETERMINED], np.zeros((NOTHING + 1, 1), np.float32), np.zeros((1, 1)), *_sequences([]))
    wanted = min(per_lang, max(LEAST_SAMPLE, per_lang * FULL_SAMPLES // len(counts)))
    # hashes are uniform: so many of each language lie below its limit that the least `wanted` are among them
    limits = [(r["lang"], min(2**63 - 1, int(2**64 * (2 * wanted + 50) / r["count"]) - 2**63)) for r in counts]
    low = F.broadcast(docs.sparkSession.createDataFrame(limits, "lang string, high long"))
    found = sorted((r["lang"], r["at"]) for r in keys.join(low, "lang").where("at <= high").select("lang", "at").collect())
    chosen: dict[str, list[int]] = {}
    for lang, at in found:
        own = chosen.setdefault(lang, [])
        if len(own) < wanted:
            own.append(at)
    picked = docs.sparkSession.createDataFrame([(lang, at) for lang, own in chosen.items() for at in own], "lang string, at long")
    piece = stretch("text", max_chars, F.xxhash64("at")).alias("text")
    drawn = usable.join(F.broadcast(picked), ["lang", "at"]).select("lang", "at", piece).dropDuplicates(["lang", "at"])
    sample = sorted((r["lang"], r["text"]) for r in drawn.collect())
    return train([t for _, t in sample], [name for name, _ in sample])


def identify(docs: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (mean marginal of that language) of every row, in whole texts.

    Null texts and texts without a letter are ``und`` with score 0. Repeated rows give repeated results; a null
    id stays null.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights for each language

    def run(piece, texts):
        langs, scores = sent.value.predict(texts)
        return {"doc_id": piece.column(0), "lang_pred": langs, "score": scores}

    return map_texts(id_and_text(docs, id_col, text_col), run, "doc_id long, lang_pred string, score double")


def accepted(docs: DataFrame, model: Crf, least: float = LEAST_FAMILIAR, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in languages of the model: with letters, of which enough stand as in the learned texts.

    Each word may be in another language, so texts that switch between languages stay; other languages, other scripts
    and strings of letters go. Null texts and texts without a letter go. A missing language is filled in. Rows that
    repeat an id are judged each by its own text. The columns are those of ``docs``, whatever their names.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # as in identify
    found, familiar = free_name(docs, "lang_found"), free_name(docs, "familiar")

    def run(texts):
        langs, _, shares = sent.value.judged(texts)
        return {found: langs, familiar: shares}

    marked = extend_texts(docs, run, f"{found} string, {familiar} double", text_col)
    left = marked.where((F.col(found) != UNDETERMINED) & (F.col(familiar) >= least))
    return left.select(*(F.coalesce(c, found).alias(c) if c == lang_col else F.col(f"`{c}`") for c in docs.columns))


def training_rows(docs: DataFrame) -> DataFrame:
    """Documents outside the held-out fold."""
    return docs.where(fold(F.col("doc_id"), 5) != 0)


def op10_language_id(docs: DataFrame) -> DataFrame:
    """Every document's language by a model learned from those outside the held-out fold."""
    return identify(docs, fit(training_rows(docs))).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score"
    )
