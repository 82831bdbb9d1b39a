"""Removed repeats against a scan of all windows."""

import hashlib
import random

import pytest

from basketflow.llm import substring_dedup
from basketflow.llm.substring_dedup import digests, remove_repeats


def brute_force(rows, size=13):
    first = {}
    for i, text in rows:
        w = (text or "").encode().split()
        for k in range(len(w) - size + 1):
            if i is not None:
                key = tuple(w[k : k + size])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, text in rows:
        w = (text or "").encode().split()
        stays = [True] * len(w)
        for k in range(len(w) - size + 1):
            if i is not None and first[tuple(w[k : k + size])] < i:
                stays[k : k + size] = [False] * size
        kept = b" ".join(x for x, y in zip(w, stays, strict=True) if y)
        out.append((i, len(w), stays.count(False), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)]
    passages = [rng.choices(words, k=k) for k in (12, 13, 14, 20, 60)]
    rows = []
    for i in rng.sample(range(1000), 60):
        text = rng.choices(words, k=rng.choice([0, 5, 30]))
        for _ in range(rng.randrange(4)):
            passage = rng.choice(passages)
            cut = rng.randrange(3)
            text += passage[cut:] + rng.choices(words, k=rng.randrange(6))
        rows.append((i, rng.choice([" ", "  ", "\n"]).join(text)))
    return [*rows, (2000, rows[0][1]), (2001, "a " * 40), (2002, "a " * 50)]


@pytest.mark.parametrize(("seed", "at_once"), [(1, 2_000_000), (2, 50), (3, 1)])
def test_equals_all_windows(documents, monkeypatch, seed, at_once):
    """Also with tasks that can settle nothing alone."""
    monkeypatch.setattr(substring_dedup, "ENTRIES_AT_ONCE", at_once)
    monkeypatch.setattr(substring_dedup, "ENTRIES_A_RANGE", 300)
    rows = corpus(seed)
    assert sorted(map(tuple, digests(remove_repeats(documents(rows, 7))).collect()), key=str) == brute_force(rows)


def test_odd_texts(documents, odd_texts):
    rows = [*odd_texts, (30, "word " * 20), (31, None)]
    assert sorted(map(tuple, digests(remove_repeats(documents(rows))).collect()), key=str) == brute_force(rows)


def test_empty_table(documents):
    assert remove_repeats(documents([])).count() == 0


def test_ids_far_apart_pack_and_unpack():
    import numpy as np

    for ids in ([], [5], [-3, -3, 9], [0, 70_000], [-(2**62), 2**62]):
        raw = np.array(ids, dtype=np.int64)
        if len(raw):
            assert (substring_dedup._unpacked_ids(substring_dedup._packed_ids(raw)) == raw).all()
