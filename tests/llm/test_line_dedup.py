"""Lines shared by documents against a version that counts them in a dictionary, and the filters themselves."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basketflow.llm import line_dedup as d

WHITE = " \t\n\x0b\x0c\r"


def key_of(line, least):
    key = "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))
    return key if len(key) >= least else None


def brute_force(rows, least=20, docs=3):
    holders = defaultdict(set)
    for i, text in rows:
        if i is not None:
            for line in (text or "").split("\n"):
                holders[key_of(line, least)].add(i)
    gone = {k: max(ids) for k, ids in holders.items() if k is not None and len(ids) >= docs}
    result = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = lines if i is None else [x for x in lines if gone.get(key_of(x, least), i) == i]
        result.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(result)


def rows_of(df):
    assert df.columns == ["doc_id", "n_lines", "n_dropped", "kept"]
    return Counter(tuple(r) for r in df.collect())


COMMON = "  A line that Many documents share \t"
TEXTS = [
    (11, f"{COMMON}\nonly here, and long enough\nshort"),
    (12, f"short\n{COMMON.lower()}\n{COMMON}"),
    (13, f"{COMMON.strip()}\r\n\n\x0bin two documents only, no more\n"),
    (14, f"in two documents only, no more\n{COMMON.upper()}\n{COMMON}\n{COMMON}"),
    (15, "short\nÉcole supérieure de commerce"),
    (16, "école supérieure de commerce\n\xa0École supérieure de commerce"),
    (17, "x" * 19 + "\n" + "y" * 20),
    (18, "x" * 19 + "\n" + "y" * 20),
    (19, "x" * 19 + "\n" + "Y" * 20 + "\r"),
    (20, "日本" * 10),
    (21, "日本" * 10 + "\n"),
    (22, "\n\n" + "日本" * 10),
]


@pytest.mark.parametrize(("partitions", "a_range"), [(1, 1_000_000), (7, 2)])
def test_equals_brute_force(documents, odd_texts, monkeypatch, partitions, a_range):
    """In one task and one range, and in many."""
    if a_range == 2:
        monkeypatch.setattr(d, "ENTRIES_AT_ONCE", 3)
    rows = [*TEXTS, *odd_texts, (None, COMMON), (12, f"another row of the id\n{COMMON}")]
    found = rows_of(d.drop_shared_lines(documents(rows, partitions), entries_a_range=a_range))
    assert found == brute_force(rows)
    assert sum(n for _, _, n, _ in found.elements()) == 9  # 5, 2 and 2 of three keys


def test_shuffled_where_too_much_for_a_broadcast(documents, monkeypatch):
    monkeypatch.setattr(d, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(d, "BROADCAST_VERDICTS", -1)
    assert rows_of(d.drop_shared_lines(documents(TEXTS))) == brute_force(TEXTS)


def test_other_bounds(documents):
    rows = [(i, "ab\nabc\nabcd") for i in range(5)] + [(9, "abcd")]
    found = rows_of(d.drop_shared_lines(documents(rows), min_chars=3, min_docs=6))
    assert found == brute_force(rows, 3, 6) and sum(n for _, _, n, _ in found.elements()) == 5


def test_a_line_of_every_document(documents):
    rows = [(i, f"line of {i}: {i * 7919}, its own\n{COMMON}") for i in range(400)]
    found = rows_of(d.drop_shared_lines(documents(rows, 8)))
    assert found == brute_force(rows) and sum(n for _, _, n, _ in found.elements()) == 399


def test_empty_table(documents):
    assert rows_of(d.drop_shared_lines(documents([(1, "x")]).where("doc_id > 1"))) == {}


def test_digests(documents):
    rows = d.digests(d.drop_shared_lines(documents([(1, None)]))).collect()
    assert [tuple(r) for r in rows] == [(1, 1, 0, "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855")]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=300))
def test_filter_forgets_nothing(keys):
    keys = np.array(keys, dtype=np.uint64)
    bloom = d.Bloom(len(keys))
    bloom.add(keys)
    assert bloom.holds(keys).all()


def test_false_alarms_are_few():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**64 - 1, 40_000, dtype=np.uint64)
    bloom = d.Bloom(20_000)
    bloom.add(keys[:20_000])
    assert bloom.holds(keys[20_000:]).mean() < 0.01
