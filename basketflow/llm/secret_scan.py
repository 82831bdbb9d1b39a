"""Secrets in texts: fixed patterns, and random strings that a tokenizer splits into many short tokens.

Ordinary words need few tokens for their characters, random strings many: characters per token tell them apart.
Strings that are plainly a digest or an identifier are not counted as secrets by that test.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import extend_texts, free_name, id_and_text, map_texts

# The base patterns.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")
LEAST = {"assign": 6, "access": 20, "hex": 24}

_ASSIGN, _ACCESS, _HEX = re.compile(ASSIGN, re.IGNORECASE | re.ASCII), re.compile(ACCESS), re.compile(HEX)
_KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
_HEX_BYTES = bytes(0x78 if chr(b) in "0123456789abcdef" else 0x20 for b in range(256))
_RUN_OF_HEX = b"x" * LEAST["hex"]

#: A string is tested if it has this many characters and at least two of lower case, upper case and digits.
RUN_LEAST = 20
#: Fewer characters a token than this are random.
RATIO = 2.0
_RUN = np.array([chr(b).isascii() and (chr(b).isalnum() or chr(b) in "+/=_-") for b in range(256)])
_CLASSES = tuple(re.compile(x) for x in ("[a-z]", "[A-Z]", "[0-9]"))
_DIGEST = re.compile(r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})")
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
#: What stands between separators; a UUID is one part.
_SEPARATORS = "/=_-+"
_PART = re.compile(rf"{_UUID.pattern}(?![0-9a-zA-Z])|[^{re.escape(_SEPARATORS)}]+")
#: A part of a key between two separators may be a name by chance if it has fewer characters than this.
SHORT_NAME = 4
#: Words and numbers with separators between; every repetition is possessive, so that the test is linear.
_NAME = re.compile(r"(?![-_/=+])(?:[A-Z]*+[a-z]{2,}+|[A-Z]{2,}+|[0-9]++|[-_/=+]++)++")


@lru_cache(maxsize=2)
def vocabulary(path: str | None = None) -> tiktoken.Encoding:
    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the three fixed patterns: leftmost, non-overlapping per kind, too short ones dropped."""
    found = []
    folded = text.lower()
    if any(word in folded for word in _KEYWORDS):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    if _RUN_OF_HEX in text.encode().translate(_HEX_BYTES):
        found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def identifier(run: str) -> bool:
    """A digest, a UUID, or words and short numbers put together."""
    return bool(_DIGEST.fullmatch(run) or _UUID.fullmatch(run) or (_NAME.fullmatch(run) and not _mixed_often(run)))


def _mixed_often(run: str) -> bool:
    """Changes between letters and digits, or to upper case, at more than every fourth character."""
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "-" for c in run]
    return 4 * sum(a != b and a + b != "ul" for a, b in zip(kinds, kinds[1:], strict=False)) > len(run)


def _classes(run: str) -> int:
    return sum(bool(c.search(run)) for c in _CLASSES)


def _random(run: str, encoding: tiktoken.Encoding, ratio: float) -> bool:
    return len(run) >= RUN_LEAST and _classes(run) > 1 and not identifier(run) and len(run) < ratio * len(encoding.encode_ordinary(run))


def _stretches(run: str) -> list[tuple[int, int]]:
    """Where text that is no name stands in a run: from one such part to another, with none but short names between."""
    found: list[tuple[int, int]] = []
    mixed = joins = False  # whether the last stretch has a part of several classes; whether it may go on
    for part in _PART.finditer(run):
        if identifier(part[0]):
            joins = joins and len(part[0]) < SHORT_NAME
            continue
        if joins:
            begin = found.pop()[0] if mixed else opened
            mixed = mixed or _classes(part[0]) > 1
        else:
            begin, mixed = part.start(), _classes(part[0]) > 1
        opened, joins = begin, True
        if mixed:
            found.append((begin, part.end()))
    return found


def _random_in(run: str, encoding: tiktoken.Encoding, ratio: float) -> list[tuple[int, int]]:
    """The whole run if it is random, else its random stretches and in the others the random parts."""
    if _classes(run) < 2:
        return []
    if _random(run, encoding, ratio):
        return [(0, len(run))]
    found = []
    for begin, end in _stretches(run):
        if _random(run[begin:end], encoding, ratio):
            found.append((begin, end))
        else:
            found += [m.span() for m in _PART.finditer(run, begin, end) if _random(m[0], encoding, ratio)]
    return found


def random_spans(text: str, encoding: tiktoken.Encoding, ratio: float = RATIO) -> list[tuple[int, int, str]]:
    """Of maximal runs of key characters, those with few characters per token, other than identifiers.

    Ordinary words with separators do not hide a key: what lies between / = _ - + is tested too.
    """
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    outside = np.flatnonzero(~_RUN[raw])
    edges = np.concatenate([[-1], outside, [len(raw)]])
    found = []
    for k in np.flatnonzero(np.diff(edges) > RUN_LEAST):
        begin, end = int(edges[k]) + 1, int(edges[k + 1])
        inside = _random_in(raw[begin:end].tobytes().decode(), encoding, ratio)
        if inside:
            start = int(((raw[:begin] & 0xC0) != 0x80).sum())
            found += [(start + b, start + e, "random") for b, e in inside]
    return found


def _uncovered(text: str, span: tuple[int, int, str], base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """What base spans leave of a random one, without separators at the ends and without plain words."""
    pieces, at = [], span[0]
    for begin, end, _ in base:
        if begin < span[1] and at < end:
            pieces.append((at, begin))
            at = end
    if at == span[0] and not pieces:
        return [span]
    left = []
    for begin, end in [*pieces, (at, span[1])]:
        piece = text[begin:end].rstrip(_SEPARATORS)
        begin, piece = begin + len(piece) - len(piece.lstrip(_SEPARATORS)), piece.lstrip(_SEPARATORS)
        if _classes(piece) > 1 and not identifier(piece):
            left.append((begin, begin + len(piece), "random"))
    return left


def spans(text: str, encoding: tiktoken.Encoding) -> list[tuple[int, int, str]]:
    """Base spans, and what they do not cover of random strings."""
    base = base_spans(text)
    more = random_spans(text, encoding)
    if more and base:
        more = [x for span in more for x in _uncovered(text, span, base)]
    return sorted(base + more, key=lambda x: (x[0], KINDS.index(x[2])))


def redacted(text: str, found: list[tuple[int, int, str]], mark: str = "<SECRET>") -> str:
    """The text with each span, or run of touching spans, replaced by ``mark``."""
    out, at = [], 0
    for begin, end, _ in found:
        if begin >= at:
            out += [text[at:begin], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, vocabulary_path: str | None = None, redact: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans (kind, begin, end in characters, end exclusive; by begin) of every row, with ``redact`` also clean_text.

    Null texts count as empty and have no spans. Repeated rows give repeated results; a null id stays null.
    ``vocabulary_path`` names a tiktoken rank file, the same on every executor.
    """
    schema = "doc_id long, spans array<struct<kind:string,begin:int,end:int>>" + ", clean_text string" * redact

    def run(piece, texts):
        encoding = vocabulary(vocabulary_path)
        found = [spans(t, encoding) for t in texts]
        columns = {"doc_id": piece.column(0), "spans": [[{"kind": k, "begin": b, "end": e} for b, e, k in x] for x in found]}
        if redact:
            columns["clean_text"] = [redacted(t, x) for t, x in zip(texts, found, strict=True)]
        return columns

    return map_texts(id_and_text(docs, id_col, text_col), run, schema)


def cleaned(docs: DataFrame, vocabulary_path: str | None = None, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with secrets cut out of the texts and the length column, if there is one, brought up to date.

    Null texts stay null, texts without secrets stay as they are.
    """

    clean = free_name(docs, "clean")

    def run(texts):
        encoding = vocabulary(vocabulary_path)
        found = [spans(t, encoding) for t in texts]
        return {clean: [redacted(t, x) if x else None for t, x in zip(texts, found, strict=True)]}

    marked = extend_texts(docs, run, f"{clean} string", text_col)
    changed = F.col(clean).isNotNull()
    columns = {text_col: F.coalesce(clean, text_col)}
    if length_col in docs.columns:
        columns[length_col] = F.when(changed, F.length(clean).cast(docs.schema[length_col].dataType)).otherwise(F.col(length_col))
    return marked.withColumns(columns).drop(clean)


def digests(found: DataFrame) -> DataFrame:
    """Counts by kind and the joined spans of ``scan``."""
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    joined = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ",")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in KINDS),
        F.sha2(joined(F.filter("spans", lambda s: s["kind"] != "random")).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
