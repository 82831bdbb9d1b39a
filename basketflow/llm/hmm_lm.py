"""A hidden Markov language model: counts over the corpus, Baum-Welch over partitions, exact scaled forward scores.

Tokens are words, lower-cased in A-Z, and one end per text. Latent states emit token classes: each of the most
frequent tokens is a class of its own, the others fall into classes by their last two bytes. Within a class a token
has its smoothed share of the corpus counts, so the model covers every text.

Tokens that make up at least one part in ``FREQUENT`` of the corpus number at most ``FREQUENT``; they are broadcast.
All others are looked up by a join, in which none of them can be a hot key for the same reason.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.chains import Steps
from basketflow.llm.common import fold, map_texts, ship, slices, texts_of
from basketflow.shared import as_table

FREQUENT = 1 << 20
OWN_CLASSES = 4_000
ENDING_CLASSES = 1_024
CLASSES = 1 + OWN_CLASSES + ENDING_CLASSES
END = b""
#: In training, chains longer than this are cut; the later parts begin in any state. Scores never cut a chain.
PART = 1_024
TOKENS_AT_ONCE = 600_000
#: Steps of a recursion between two scalings; emissions are taken relative to the largest of their class.
SCALE_EVERY = 16


def tokens_of(text: str) -> list[bytes]:
    """Words of ASCII white space, lower-cased in A-Z, and the end."""
    words = text.encode().lower().split()
    words.append(END)
    return words


def ending_class(token: bytes) -> int:
    return 1 + OWN_CLASSES + zlib.crc32(token[-2:]) % ENDING_CLASSES


def count_tokens(texts: DataFrame) -> DataFrame:
    """token (binary, the end is empty) and c over all rows of ``texts`` (id, text); tasks add up before the shuffle."""
    ship(texts.sparkSession)

    def run(batches):
        counts: Counter = Counter()
        for piece in slices(batches):
            for text in texts_of(piece):
                counts.update(tokens_of(text))
            if len(counts) > 300_000:
                yield from packed(counts)
                counts = Counter()
        yield from packed(counts)

    def packed(counts):
        keys, values = list(counts), list(counts.values())
        for begin in range(0, len(keys), 50_000):
            end = begin + 50_000
            yield pa.RecordBatch.from_arrays([pa.array(keys[begin:end], pa.binary()), pa.array(values[begin:end], pa.int64())], names=["token", "c"])

    return texts.mapInArrow(run, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


@dataclass
class Lexicon:
    """Counts of frequent tokens, corpus totals, and totals of the classes by ending."""

    number: dict[bytes, int]
    classes: np.ndarray
    log_counts: np.ndarray
    tokens: int
    distinct: int
    log_class_totals: np.ndarray
    class_counts: np.ndarray


def lexicon(counts: DataFrame) -> Lexicon:
    """From the table of counts; at most ``FREQUENT`` tokens reach the driver."""
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    tokens, distinct = int(total["n"] or 0), int(total["v"])
    often = counts.where(F.col("c") * FREQUENT >= tokens).toArrow()
    words, c = often["token"].to_pylist(), often["c"].to_numpy()
    ranked = sorted((i for i in range(len(words)) if words[i] != END), key=lambda i: (-c[i], words[i]))
    classes = np.array([ending_class(w) for w in words], dtype=np.uint16)
    classes[ranked[:OWN_CLASSES]] = np.arange(1, 1 + len(ranked[:OWN_CLASSES]))
    own = {words[i] for i in ranked[:OWN_CLASSES]} | {END}
    if END in words:
        classes[words.index(END)] = 0
    totals, distinct_of = np.zeros(CLASSES), np.zeros(CLASSES)
    ending = F.crc32(F.substring("token", -2, 2)) % ENDING_CLASSES
    for r in counts.where("length(token) > 0").groupBy(ending.alias("k")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        totals[1 + OWN_CLASSES + r["k"]] = r["n"] + r["v"]
        distinct_of[1 + OWN_CLASSES + r["k"]] = r["v"]
    for w, n in zip(words, c, strict=True):
        if w in own and w != END:
            totals[ending_class(w)] -= n + 1
            distinct_of[ending_class(w)] -= 1
    class_counts = totals - distinct_of
    for w, k, n in zip(words, classes, c, strict=True):
        if w in own:
            class_counts[k] = n
    logs = np.log10(totals + 1)
    logs[: 1 + OWN_CLASSES] = 0
    return Lexicon({w: i for i, w in enumerate(words)}, classes, np.log10(c + 1.0), tokens, distinct, logs, class_counts)


def encoded(docs: DataFrame, sent) -> DataFrame:
    """Each text as classes, its sums over frequent tokens, and its other tokens with their number.

    ``known_log`` adds log10(c + 1) over all frequent tokens, ``within`` log10 of the share in the class over the
    tokens that are not a class of their own, as far as they are frequent.
    """
    schema = "doc_id long, held_out boolean, n_tokens long, n_frequent long, known_log double, within double, classes binary, rare array<struct<token:binary,n:int>>"

    def run(piece, texts):
        known: Lexicon = sent.value
        own_until = 1 + OWN_CLASSES
        columns: dict[str, list] = {name: [] for name in ("n_tokens", "n_frequent", "known_log", "within", "classes", "rare")}
        get, endings = known.number.get, {}
        for text in texts:
            tokens = tokens_of(text)
            index = np.array([get(t, -1) for t in tokens], dtype=np.int64)
            rare = [tokens[i] for i in np.flatnonzero(index < 0)]
            classes = known.classes[index] if len(known.classes) else np.zeros(len(index), dtype=np.uint16)
            for t in rare:
                if t[-2:] not in endings:
                    endings[t[-2:]] = ending_class(t)
            classes[index < 0] = [endings[t[-2:]] if t else 0 for t in rare]
            frequent = index[index >= 0]
            logs = known.log_counts[frequent]
            columns["n_tokens"].append(len(tokens))
            columns["n_frequent"].append(len(frequent))
            columns["known_log"].append(float(logs.sum()))
            columns["within"].append(float(logs[known.classes[frequent] >= own_until].sum() - known.log_class_totals[classes].sum()))
            columns["classes"].append(classes.tobytes())
            columns["rare"].append([{"token": t, "n": n} for t, n in Counter(rare).items()])
        return {"doc_id": piece.column(0), "held_out": piece.column(2), **columns}

    return map_texts(docs.select("doc_id", "text", "held_out"), run, schema)


@dataclass
class Hmm:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # classes x states

    @property
    def states(self) -> int:
        return len(self.start)

    def resting(self) -> np.ndarray:
        """The distribution that moves do not change."""
        share = np.full(self.states, 1 / self.states)
        for _ in range(200):
            share = share @ self.move
        return share / share.sum()

    def _laid(self, classes: np.ndarray, lengths: np.ndarray) -> tuple[Steps, np.ndarray, np.ndarray, np.ndarray]:
        """Chains step by step, their classes and emissions in that layout, and the largest emission of each class."""
        steps, peak = Steps(lengths), self.emit.max(axis=1)
        laid = np.empty_like(classes)
        laid[steps.place] = classes
        return steps, laid, (self.emit / peak[:, None])[laid], peak

    def log10(self, classes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """log10 likelihood of each chain, by the scaled forward recursion over whole chains."""
        steps, laid, emit, peak = self._laid(classes, lengths)
        values, scales = steps.forward(self.start, self.move, emit, SCALE_EVERY)
        logs = np.log10(scales) + np.log10(peak)[laid]
        total = np.bincount(steps.chain, logs[steps.place], len(lengths))
        total[lengths > 0] += np.log10(values[steps.last(lengths)].sum(axis=1))
        return total

    def expected(self, classes: np.ndarray, lengths: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected first states, moves and emissions (classes x states) of chains that begin in ``start``."""
        steps, laid, emit, _ = self._laid(classes, lengths)
        forward, scales = steps.forward(start, self.move, emit, SCALE_EVERY)
        backward = steps.backward(self.move, emit, scales)
        both = forward * backward
        # the likelihood of the chain, as far as it is not in the scales
        both /= both.sum(axis=1, keepdims=True)
        before = steps.before()
        from_, into = forward[before], (emit * backward)[len(emit) - len(before) :]
        into /= ((from_ @ self.move) * into).sum(axis=1, keepdims=True)
        moves = from_.T @ into * self.move
        by_state = np.ascontiguousarray(both.T)
        emitted = np.stack([np.bincount(laid, x, CLASSES) for x in by_state], axis=1)
        return both[: len(emit) - len(into)].sum(axis=0), moves, emitted


def _gathered(batches, classes_at: int):
    """Chains of several rows, about ``TOKENS_AT_ONCE`` together: rows, classes and lengths."""
    for batch in batches:
        begin, tokens = 0, 0
        sizes = [len(v.as_buffer()) // 2 for v in batch.column(classes_at)]
        for i, n in enumerate([*sizes, TOKENS_AT_ONCE + 1]):
            if i > begin and tokens + n > TOKENS_AT_ONCE:
                part = batch.slice(begin, i - begin)
                classes = np.frombuffer(b"".join(part.column(classes_at).to_pylist()), dtype=np.uint16)
                yield part, classes.astype(np.int64), np.array(sizes[begin:i])
                begin, tokens = i, 0
            tokens += n


def _first_model(shares: np.ndarray, states: int, seed: int) -> Hmm:
    """Random emissions around the shares; states tend to stay, so that few rounds tell kinds of text apart."""
    rng = np.random.default_rng(seed)
    emit = (shares + 1e-9)[:, None] * rng.gamma(1.0, 1.0, (len(shares), states))
    return Hmm(np.full(states, 1 / states), 0.9 * np.eye(states) + 0.1 / states, emit / emit.sum(axis=0))


def baum_welch(chains: DataFrame, class_counts: np.ndarray, states: int = 8, rounds: int = 4, seed: int = 5) -> Hmm:
    """Train on all rows of ``chains`` (classes), whose classes add up to ``class_counts``. Tasks add up their expected
    counts, a shuffle adds up those of tasks.

    What comes back each round is a table of states x (states + classes) sums, whatever the corpus.
    """
    spark = chains.sparkSession
    ship(spark)
    shares = class_counts + 1e-2
    shares = shares / shares.sum()
    model = _first_model(shares, states, seed)
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(model)

        def run(batches, sent=sent):
            own: Hmm = sent.value
            n = own.states
            sums = [np.zeros(n), np.zeros((n, n)), np.zeros((CLASSES, n))]
            for _, classes, lengths in _gathered(batches, 0):
                parts = -(-lengths // PART)
                inner = np.full(parts.sum(), PART)
                ends = np.cumsum(parts)
                inner[ends - 1] = lengths - (parts - 1) * PART
                first = np.zeros(len(inner), dtype=bool)
                first[ends - parts] = True
                at = np.repeat(first, inner)
                for chosen, start in ((first, own.start), (~first, own.resting())):
                    if chosen.any():
                        found = own.expected(classes[at if chosen is first else ~at], inner[chosen], start)
                        for total, more in zip(sums, found, strict=True):
                            total += more if total is not sums[0] or chosen is first else 0
            rows = [(kind, *np.nonzero(x), x[np.nonzero(x)]) for kind, x in enumerate((sums[0][None], sums[1], sums[2]))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.full(len(r[3]), r[0]) for r in rows]), pa.int32()),
                    pa.array(np.concatenate([r[1] for r in rows]), pa.int32()),
                    pa.array(np.concatenate([r[2] for r in rows]), pa.int32()),
                    pa.array(np.concatenate([r[3] for r in rows]), pa.float64()),
                ],
                names=["kind", "i", "j", "x"],
            )

        sums = chains.select("classes").mapInArrow(run, "kind int, i int, j int, x double").groupBy("kind", "i", "j").agg(F.sum("x").alias("x")).toArrow()
        kind, i, j, x = (sums[k].to_numpy() for k in ("kind", "i", "j", "x"))
        emitted = np.zeros((CLASSES, states))
        emitted[i[kind == 2], j[kind == 2]] = x[kind == 2]
        first, moves = np.full(states, 0.1), np.full((states, states), 0.1)
        first[j[kind == 0]] += x[kind == 0]
        moves[i[kind == 1], j[kind == 1]] += x[kind == 1]
        emitted += shares[:, None]
        model = Hmm(first / first.sum(), moves / moves.sum(axis=1, keepdims=True), emitted / emitted.sum(axis=0))
    return model


def score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held: int = 2, states: int = 8, rounds: int = 4
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row, both in log10.

    The model learns from rows whose crc32 of the id modulo ``folds`` is not ``held``; a null id is learned from.
    Null texts count as empty: their only token is the end. base_score is the smoothed unigram likelihood, score the
    hidden Markov model's. Rows that repeat an id get a result each. Without rows to learn from every token is unknown.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.coalesce(fold(F.col(id_col).cast("long"), folds) == held, F.lit(False)).alias("held_out"),
    )
    spark = docs.sparkSession
    counts = as_table(count_tokens(rows.where(~F.col("held_out")).select("doc_id", "text")), "counts")
    known = lexicon(counts)
    sent = spark.sparkContext.broadcast(known)  # at most FREQUENT tokens
    table = as_table(encoded(rows, sent).withColumn("row", F.monotonically_increasing_id()), "encoded")
    model = baum_welch(table.where(~F.col("held_out")), known.class_counts, states, rounds)
    sent_model = spark.sparkContext.broadcast(model)  # of fixed size

    def forward(batches):
        for part, classes, lengths in _gathered(batches, 1):
            yield pa.RecordBatch.from_arrays([*part.columns[:1], *part.columns[2:], pa.array(sent_model.value.log10(classes, lengths))], names=[*part.schema.names[:1], *part.schema.names[2:], "chain"])

    chains = table.select("row", "classes", "doc_id", "held_out", "n_tokens", "n_frequent", "known_log", "within").mapInArrow(
        forward, "row long, doc_id long, held_out boolean, n_tokens long, n_frequent long, known_log double, within double, chain double"
    )
    rare = table.select("row", F.explode("rare").alias("r")).select("row", "r.token", "r.n").join(counts, "token")
    sums = rare.groupBy("row").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("log"))
    more = F.coalesce("log", F.lit(0.0))
    norm = float(np.log10(known.tokens + known.distinct + 1))
    return chains.join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_frequent") + F.coalesce("n", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("known_log") + more - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        (F.col("chain") + F.col("within") + more).alias("score"),
    )
