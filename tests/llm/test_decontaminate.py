"""Pigeonhole search against plain dynamic programming."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from basketflow.llm.decontaminate import LEAST_CHARS, Finder, contaminated, edit_distance, normalised, unsearchable


def plain_distance(pattern, text):
    before = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        now = [i]
        for j, d in enumerate(text, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (c != d)))
        before = now
    return min(before)


@settings(max_examples=300, deadline=None)
@given(st.text("abc", min_size=1, max_size=20), st.text("abc", max_size=30))
def test_bit_parallel_distance(pattern, text):
    assert edit_distance(pattern, text)[0] == plain_distance(pattern, text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=30), min_size=1, max_size=3), st.text("ab", max_size=60), st.sampled_from([0.0, 0.1, 0.25]))
def test_finder_equals_plain_search(items, text, budget):
    got = Finder(list(enumerate(items)), budget).find(text)
    wanted = {i: d for i, t in enumerate(items) if (d := plain_distance(t, text)) <= int(budget * len(t))}
    assert got.keys() == wanted.keys()
    assert all(wanted[i] <= got[i] <= int(budget * len(items[i])) for i in got)


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        out[at : at + (kind != 0)] = [] if kind == 1 else [rng.choice("xyz")]
    return "".join(out)


def test_planted_items(spark, documents):
    rng = random.Random(2)
    words = ["alpha", "beta", "gamma", "delta", "river", "stone", "cloud", "ocean"]
    items = [(k, " ".join(rng.choices(words, k=25))) for k in range(30)]
    rows, wanted = [], set()
    for k, text in items:
        filler = lambda: " ".join(rng.choices(words, k=20))
        rows.append((k, f"{filler()} {edited(rng, text, int(0.1 * len(text)))} {filler()}"))
        rows.append((100 + k, f"{filler()}, {text.upper().replace(' ', '!! ')} {filler()}"))
        rows.append((200 + k, filler()))
        wanted |= {(k, k), (100 + k, k)}
    table = spark.createDataFrame(items, "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in contaminated(documents(rows), table).collect()} == wanted


def test_odd_rows(spark, documents, odd_texts):
    items = spark.createDataFrame(
        [(1, None), (2, ""), (3, "too short"), (4, "twice the same row of words"), (None, "no id but some words in a row"), (5, "word " * 10), (5, "word " * 10)],
        "item_id long, text string",
    )
    got = sorted(map(tuple, contaminated(documents(odd_texts), items).collect()))
    assert got == [(4, 5, 0, 4), (6, 4, 0, 2), (6, 4, 0, 2)]
    assert contaminated(documents([]), items).count() == 0
    assert contaminated(documents(odd_texts), items.limit(0)).count() == 0


def test_short_items(spark, documents):
    items = spark.createDataFrame(
        [(1, "Is Paris big?"), (2, "猫は魚が好きですか"), (3, "42"), (4, "서울은 어디"), (5, "?!"), (6, None), (None, "big"), (7, "cat")], "item_id long, text string"
    )
    rows = [
        (1, "they ask: is paris, big and old"), (2, "is paris bigger"), (3, "質問。猫は魚が好きですか、答え"), (4, "ああ猫は魚が好きですかああ"), (5, "猫は魚が好きで"),
        (6, "it is 42"), (7, "it is 421 or 142 or 4 2"), (8, "그는 서울은 어디에 있는지"), (9, "concatenate cats, a Cat!"), (10, "concatenate cats"), (11, "this paris big"),
    ]
    got = sorted(map(tuple, contaminated(documents(rows), items).collect()))
    assert got == [(1, 1, 0, 0), (3, 2, 0, 0), (4, 2, 0, 0), (6, 3, 0, 0), (8, 4, 0, 0), (9, 7, 0, 0)]
    assert sorted((r[0] for r in unsearchable(items).collect()), key=str) == [5, 6, None]


def test_items_in_blocks(spark, documents, monkeypatch):
    monkeypatch.setattr("basketflow.llm.decontaminate.ITEMS_AT_ONCE", 2)
    texts = [" ".join(f"{k}{j}word" for j in range(8)) for k in range(7)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    assert contaminated(documents(list(enumerate(texts))), items).count() == 7


def test_normalised():
    assert normalised(" A,b…C—d\n\n “É” x_y ") == "a b c d é x y"
    assert LEAST_CHARS > 0
