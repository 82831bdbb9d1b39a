"""Counts and base scores against plain sums; the model's likelihood against summation over all state paths."""

import math
import random
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest

from basketflow.llm import hmm_lm
from basketflow.llm.chains import Steps
from basketflow.llm.hmm_lm import Hmm, score, tokens_of


def base_scores(rows):
    counts = Counter(t for i, text in rows if i is None or zlib.crc32(str(i).encode()) % 7 != 2 for t in tokens_of(text or ""))
    n, v = sum(counts.values()), len(counts)
    return [
        (i, len(w), sum(counts[t] > 0 for t in w), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in w))
        for i, text in rows
        for w in [tokens_of(text or "")]
    ]


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    return [(i, " ".join(rng.choices(words, [1 / (k + 1) for k in range(300)], k=rng.choice([0, 3, 40])))) for i in range(n)]


@pytest.mark.parametrize("frequent", [1 << 20, 30])
def test_base_scores(documents, monkeypatch, frequent):
    """With most tokens broadcast, and with most joined."""
    monkeypatch.setattr(hmm_lm, "FREQUENT", frequent)
    rows = corpus(80)
    got = sorted(score(documents(rows)).collect())
    for r, (i, tokens, known, n, base) in zip(got, sorted(base_scores(rows)), strict=True):
        assert (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i, tokens, known, n)
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 7 == 2)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert -1e6 < r["score"] < 0


def test_model_beats_the_base_on_held_out_text(documents):
    rng = random.Random(3)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{rng.randrange(30)}" for _ in range(60))) for i in range(150)]
    held = score(documents(rows)).where("held_out").collect()
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + 5 * len(held)


def test_forward_equals_all_paths():
    rng = np.random.default_rng(0)
    model = Hmm(rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(5), 3).T)
    chains = [[0, 4, 2, 2], [1], [3, 3, 0, 1, 2]]
    got = model.log10(np.concatenate(chains), np.array([len(c) for c in chains]))
    for chain, value in zip(chains, got, strict=True):
        total = 0.0
        for path in product(range(3), repeat=len(chain)):
            p = model.start[path[0]] * model.emit[chain[0], path[0]]
            for a, b, c in zip(path, path[1:], chain[1:], strict=False):
                p *= model.move[a, b] * model.emit[c, b]
            total += p
        assert value == pytest.approx(math.log10(total))


def test_expected_counts_add_up(monkeypatch):
    monkeypatch.setattr(hmm_lm, "CLASSES", 5)
    rng = np.random.default_rng(1)
    model = Hmm(rng.dirichlet(np.ones(2)), rng.dirichlet(np.ones(2), 2), rng.dirichlet(np.ones(5), 2).T)
    classes, lengths = rng.integers(0, 5, 12), np.array([5, 1, 6])
    first, moves, emitted = model.expected(classes, lengths, model.start)
    assert first.sum() == pytest.approx(3) and moves.sum() == pytest.approx(9)
    assert emitted.sum(axis=1) == pytest.approx(np.bincount(classes, minlength=5))


def test_steps_layout():
    steps = Steps(np.array([2, 0, 3]))
    assert steps.active.tolist() == [2, 2, 1] and sorted(steps.place.tolist()) == list(range(5))
    assert steps.place.tolist() == [1, 3, 0, 2, 4]


def test_class_shares_sum_to_one(documents):
    """Own classes are certain; the smoothed shares of an ending class, with one unseen token, add up to one."""
    counts = hmm_lm.count_tokens(documents(corpus(50)).select("doc_id", "text"))
    known = hmm_lm.lexicon(counts)
    seen = {r["token"]: r["c"] for r in counts.collect()}
    own = {t for t, i in known.number.items() if known.classes[i] <= hmm_lm.OWN_CLASSES}
    by_class: Counter = Counter()
    for token, c in seen.items():
        if bytes(token) not in own:
            by_class[hmm_lm.ending_class(bytes(token))] += c + 1
    for k, total in by_class.items():
        assert 10 ** known.log_class_totals[k] == pytest.approx(total + 1)


def test_odd_texts(documents, odd_texts):
    got = score(documents(odd_texts)).collect()
    wanted = base_scores(odd_texts)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"]) for r in got) == sorted((str(i), t, k) for i, t, k, *_ in wanted)
    assert all(r["held_out"] is not None and r["score"] <= 0 for r in got)
    assert score(documents([])).count() == 0
