import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from basketflow.llm.words import hash_words, shingle_sets, windows

TEXTS = st.lists(st.text(st.sampled_from("aAbé \t\n\x0b\x1c 🎉"), max_size=25), max_size=6)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_expression(texts):
    hashes, counts = hash_words(texts)
    words = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    assert counts.tolist() == [len(w) for w in words]
    flat = [w for x in words for w in x]
    assert len({*flat}) == len({*hashes.tolist()})
    by = {}
    assert all(by.setdefault(w, h) == h for w, h in zip(flat, hashes.tolist(), strict=True))


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_shingle_sets_have_the_right_sizes(texts):
    hashes, counts = shingle_sets(texts)
    wanted = []
    for t in texts:
        w = t.encode().lower().split()
        wanted.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    assert counts.tolist() == [len(x) for x in wanted]
    ends = np.cumsum(counts)
    got = [set(hashes[e - n : e].tolist()) for e, n in zip(ends, counts, strict=True)]
    for a in range(len(texts)):
        for b in range(a):
            assert len(got[a] & got[b]) == len(wanted[a] & wanted[b])


def test_windows_stay_in_their_text():
    words, counts = hash_words(["a b c", "b c", "", "a b c"])
    hashes, first = windows(words, counts, 2)
    assert first.tolist() == [0, 1, 3, 5, 6] and hashes[1] == hashes[2] == hashes[4]
