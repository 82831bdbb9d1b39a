"""Quality of texts by compression with dictionaries of good and of bad labelled text.

A text is compressed with either dictionary. The difference of the two sizes, normalised by the text's size, says
which kind it resembles; a logistic calibration over that difference, the two sizes and the length turns it into a
probability.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import fold, id_and_text, map_texts, stretch

DICTIONARY_BYTES = 110_000
LEVEL = 3


@dataclass
class CompressionModel:
    good: bytes
    bad: bytes
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    _pair: tuple = field(default=(), repr=False)

    def _compressors(self) -> tuple:
        if not self._pair:
            pair = []
            for content in (self.good, self.bad):
                own = zstandard.ZstdCompressionDict(content) if content else None
                if own:
                    own.precompute_compress(level=LEVEL)
                options = {"dict_data": own, "write_dict_id": False} if own else {"level": LEVEL}
                pair.append(zstandard.ZstdCompressor(write_content_size=False, **options))
            self._pair = tuple(pair)
        return self._pair

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_pair": ()}

    def sizes(self, texts: list[str]) -> np.ndarray:
        """Normalised difference, relative difference, both normalised sizes and log length of whole texts."""
        good, bad = self._compressors()
        rows = np.empty((len(texts), 5))
        for row, text in zip(rows, texts, strict=True):
            raw = text.encode()
            n, a, b = max(len(raw), 1), len(good.compress(raw)), len(bad.compress(raw))
            row[:] = (b - a) / n, (b - a) / max(a, b), a / n, b / n, np.log1p(len(raw))
        return rows

    def score(self, texts: list[str]) -> np.ndarray:
        return _sigmoid((_terms(self.sizes(texts)) - self.centre) / self.spread @ self.weights)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _terms(sizes: np.ndarray) -> np.ndarray:
    """One, the sizes, and their products."""
    first, second = np.triu_indices(sizes.shape[1])
    return np.concatenate([np.ones((len(sizes), 1)), sizes, sizes[:, first] * sizes[:, second]], axis=1)


def _dictionary(texts: list[str]) -> bytes:
    """A trained dictionary; of too few texts for training, the texts themselves."""
    raw = [t.encode() for t in texts if t]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, raw).as_bytes() if len(raw) >= 8 else b"".join(raw)[-DICTIONARY_BYTES:]
    except zstandard.ZstdError:
        return b"".join(raw)[-DICTIONARY_BYTES:]


def _calibrated(model: CompressionModel, texts: list[str], truth: np.ndarray, ridge: float = 1e-3) -> CompressionModel:
    """Penalised logistic regression by Newton's method."""
    terms = _terms(model.sizes(texts))
    model.centre, model.spread = terms.mean(axis=0), terms.std(axis=0)
    model.centre[0], model.spread[model.spread < 1e-12] = 0, 1
    x = (terms - model.centre) / model.spread
    penalty = ridge * len(truth) * np.eye(x.shape[1])
    weights = np.zeros(x.shape[1])
    for _ in range(25):
        p = _sigmoid(x @ weights)
        weights += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (truth - p) - penalty @ weights)
    model.weights = weights
    return model


def train(texts: list[str], labels: list[int], dictionary_share: float = 0.35) -> CompressionModel:
    """Dictionaries from the first share of the rows, calibration on the rest; on all rows if the rest is small."""
    cut = int(len(texts) * dictionary_share)
    by = {k: [t for t, y in zip(texts[:cut], labels[:cut], strict=True) if y == k] for k in (0, 1)}
    size = _terms(np.zeros((1, 5))).shape[1]
    model = CompressionModel(_dictionary(by[1]), _dictionary(by[0]), np.zeros(size), np.ones(size), np.zeros(size))
    rest = slice(cut, None) if len(texts) - cut >= 50 else slice(None)
    return _calibrated(model, texts[rest], np.array(labels[rest], dtype=float)) if texts else model


def fit(docs: DataFrame, labels: DataFrame, sample: int = 7_000, max_chars: int = 20_000) -> CompressionModel:
    """Train on at most ``sample`` labelled documents drawn by a hash of the id, of any length.

    That bounds what reaches the driver, as a text of over ``max_chars`` characters gives so many of them, from a place
    that the hash chooses. Null texts count as empty. Of rows that repeat an id the text first by order is taken, of
    labels that do the larger one. ``labels`` has doc_id and quality (0 or 1); other values are left out.
    """
    drawn = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("quality").alias("quality"))
        .withColumn("at", F.xxhash64("doc_id"))
        .orderBy("at", "doc_id")
        .limit(sample)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(drawn), "doc_id").select("doc_id", "at", "quality", stretch("text", max_chars, F.col("at")).alias("text"))
    rows = found.groupBy("doc_id", "at", "quality").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: (r["at"], r["text"]))
    return train([r["text"] for r in rows], [r["quality"] for r in rows])


def score(docs: DataFrame, model: CompressionModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every row, over whole texts; null and empty texts are scored as empty.

    Repeated rows give repeated results; a null id stays null.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of DICTIONARY_BYTES at most

    def run(piece, texts):
        return {"doc_id": piece.column(0), "score": sent.value.score(texts)}

    return map_texts(id_and_text(docs, id_col, text_col), run, "doc_id long, score double")


def op9_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Every document's quality by a model of labels outside the held-out fold."""
    held = fold(F.col("doc_id"), 5) == 0
    model = fit(docs.where(~held), labels.where(~held))
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
