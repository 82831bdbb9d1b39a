"""Byte-level BPE over Arrow batches: encoding with character offsets, and decoding."""

from __future__ import annotations

import codecs
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketflow.llm.common import id_and_text, map_texts, ship

VOCABULARY = "byte_bpe_50k.json"
#: Pieces whose ids a worker remembers; it starts anew when they are more.
REMEMBERED = 200_000


def byte_characters() -> dict[int, str]:
    """Byte -> the printable character that stands for it: itself, or the next one from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) if b in own else chr(0x100 + others.index(b)) for b in range(256)}


class Codec:
    """One vocabulary: text to ids piece by piece, ids to bytes, token ends in bytes and characters."""

    def __init__(self, path: str, pattern: str):
        tokenizer = Tokenizer.from_file(path)
        self._model = tokenizer.model
        self._pieces = regex.compile(pattern).findall
        to_character = byte_characters()
        to_byte = {c: b for b, c in to_character.items()}
        self._characters = {b: c for b, c in to_character.items() if chr(b) != c}
        specials = {i for i, t in tokenizer.get_added_tokens_decoder().items() if t.special}
        size = tokenizer.get_vocab_size(with_added_tokens=True)
        self.tokens = [
            b"" if i in specials else bytes(map(to_byte.__getitem__, tokenizer.id_to_token(i))) for i in range(size)
        ]
        self._known: dict[str, bytes] = {}

    def _ids(self, piece: str) -> bytes:
        mapped = piece.encode().decode("latin-1").translate(self._characters)
        return np.array([t.id for t in self._model.tokenize(mapped)], dtype=np.int32).tobytes()

    def encode(self, text: str) -> np.ndarray:
        known = self._known
        pieces = self._pieces(text)
        for piece in set(pieces).difference(known):
            known[piece] = self._ids(piece)
        ids = np.frombuffer(b"".join(map(known.__getitem__, pieces)), dtype=np.int32)
        if len(known) > REMEMBERED:
            known.clear()
        return ids

    def decode(self, ids) -> bytes:
        """Exact bytes; an unknown id is an IndexError, a null id is nothing."""
        return b"".join([self.tokens[i] for i in ids if i is not None])

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character of each token and the one after its last; parts of a character share it."""
        ends = np.cumsum([len(self.tokens[i]) for i in ids], dtype=np.int64)
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1
        begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        return (character[begins], character[ends - 1] + 1) if len(ends) else (ends, ends)

    def token_texts(self, ids) -> list[str]:
        """Text of each token; a character split over tokens goes whole to the one that ends it."""
        reader = codecs.getincrementaldecoder("utf-8")(errors="replace")
        parts = [reader.decode(self.tokens[i]) for i in ids]
        rest = reader.decode(b"", final=True)
        return [*parts[:-1], parts[-1] + rest] if parts else []


@lru_cache(maxsize=4)
def codec(path: str | None = None, pattern: str | None = None) -> Codec:
    """One per worker and vocabulary."""
    return Codec(path or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN)


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate(values) if values else np.array([], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


def encode(
    docs: DataFrame,
    vocabulary: str | None = None,
    offsets: bool = False,
    decoded: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id and ids of every row, with ``offsets`` also begins and ends in characters, with ``decoded`` the bytes again.

    ``vocabulary`` is the path of a byte-level BPE file of the tokenizers library, the same on every
    executor. Null and empty texts have no ids; rows that repeat or have a null id stay as they are.
    """
    schema = "doc_id long, ids array<int>" + ", begins array<int>, ends array<int>" * offsets + ", decoded binary" * decoded

    def run(piece, texts):
        own = codec(vocabulary)
        ids = [own.encode(text) for text in texts]
        columns = {"doc_id": piece.column(0), "ids": _lists(ids, pa.int32())}
        if offsets:
            pairs = [own.offsets(text, x) for text, x in zip(texts, ids, strict=True)]
            columns |= {n: _lists([p[k] for p in pairs], pa.int32()) for k, n in enumerate(("begins", "ends"))}
        if decoded:
            columns["decoded"] = pa.array([own.decode(x) for x in ids], pa.binary())
        return columns

    return map_texts(id_and_text(docs, id_col, text_col), run, schema)


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``encoded`` (doc_id, ids) with the decoded bytes and text; bytes that are no UTF-8 become U+FFFD in the text.

    Null ids decode to nothing.
    """

    def run(batches):
        own = codec(vocabulary)
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                raw = [own.decode(ids or ()) for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(raw, pa.binary()), pa.array([x.decode(errors="replace") for x in raw], pa.string())],
                    names=["doc_id", "ids", "decoded", "decoded_text"],
                )

    ship(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary, decoded_text string")


def digests(decoded: DataFrame, *more: str) -> DataFrame:
    """Token counts and SHA-256 of the ids' text and of the decoded bytes, and columns to carry along."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *more,
    )


