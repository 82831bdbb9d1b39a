"""Encoding and decoding against the tiktoken library, and exact round trips."""

import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from basketflow.llm import byte_bpe


@pytest.fixture(scope="module")
def reference():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_vocabulary_is_that_of_the_ranks(reference):
    tokens = byte_bpe.codec().tokens
    assert all(reference.decode_single_token_bytes(i) == tokens[i] for i in range(reference.n_vocab))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_and_round_trip_of_any_text(reference_ids, text):
    codec = byte_bpe.codec()
    ids = codec.encode(text)
    assert ids.tolist() == reference_ids(text)
    assert codec.decode(ids) == text.encode()
    assert "".join(codec.token_texts(ids)) == text


@pytest.fixture(scope="module")
def reference_ids(reference):
    return reference.encode_ordinary


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_offsets_cover_the_text(text):
    codec = byte_bpe.codec()
    ids = codec.encode(text)
    begins, ends = codec.offsets(text, ids)
    for i, begin, end in zip(ids, begins, ends, strict=True):
        assert codec.tokens[i] in text[begin:end].encode()
    assert (begins[:1] == 0).all() and (ends[-1:] == len(text)).all()


def test_special_strings_are_ordinary_text(reference):
    text = "a<|endoftext|>b"
    assert byte_bpe.codec().encode(text).tolist() == reference.encode_ordinary(text)


def test_query_on_odd_texts(spark, documents, odd_texts, reference):
    encoded = byte_bpe.encode(documents(odd_texts))
    rows = byte_bpe.digests(byte_bpe.decode(encoded)).collect()
    wanted = []
    for i, t in odd_texts:
        ids = reference.encode_ordinary(t or "")
        wanted.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=str) == sorted(wanted, key=str)


def test_offsets_column_and_broken_characters(spark, documents):
    row = byte_bpe.encode(documents([(1, "é🎉")]), offsets=True).first()
    both = byte_bpe.encode(documents([(1, "é🎉")]), decoded=True).first()
    assert bytes(both["decoded"]).decode() == "é🎉" and both["ids"] == row["ids"]
    assert row["begins"][0] == 0 and row["ends"][-1] == 2
    cut = byte_bpe.decode(spark.createDataFrame([(1, row["ids"][:-1]), (2, None)], "doc_id long, ids array<int>")).orderBy("doc_id").collect()
    assert bytes(cut[0]["decoded"]) == b"".join(byte_bpe.codec().tokens[i] for i in row["ids"][:-1])
    assert "�" in cut[0]["decoded_text"] and cut[1]["decoded_text"] == ""


def test_empty_table(spark, documents):
    empty = documents([])
    assert byte_bpe.digests(byte_bpe.decode(byte_bpe.encode(empty, offsets=True))).count() == 0
