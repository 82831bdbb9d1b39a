"""Quality and language models on held-out documents, and their defined answers for odd ones."""

import math
import random
import zlib
from itertools import product

import numpy as np
import pytest
import zstandard

from basketflow.llm import language, quality
from basketflow.llm.common import read

FOLDER = "/root/testdata/sf0.01"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_quality_of_held_out_documents(spark):
    labels = {r["doc_id"]: r["quality"] for r in read(spark, FOLDER, "labels").collect()}
    rows = quality.op9_quality(read(spark, FOLDER, "documents"), read(spark, FOLDER, "labels")).collect()
    assert len(rows) == 1000 and all(r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    test = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in test]) > 0.9
    good, bad = ([r["score"] for r in test if labels[r["doc_id"]] == k] for k in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) > 0.93


def test_quality_learns_nothing_from_the_held_out_fold(spark):
    docs, labels = read(spark, FOLDER, "documents"), read(spark, FOLDER, "labels")
    from pyspark.sql import functions as F

    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, other = (sorted(map(tuple, quality.op9_quality(docs, x).collect())) for x in (labels, turned))
    assert one == other


def test_quality_of_odd_texts(spark, documents, odd_texts):
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, None), (None, 1), (7, 9), (6, 1), (6, 1)], "doc_id long, quality int")
    for given in (labels, labels.limit(0)):
        rows = quality.op9_quality(documents(odd_texts), given).collect()
        assert len(rows) == len(odd_texts) and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.op9_quality(documents([]), labels).count() == 0


def test_quality_scores_equal_a_plain_scorer(spark):
    """Every text by itself, with compressors of its own and the sums written out."""
    docs, labels = read(spark, FOLDER, "documents"), read(spark, FOLDER, "labels")
    model = quality.fit(docs, labels)
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    for r in docs.collect():
        raw, sizes = (r["text"] or "").encode(), []
        for content in (model.good, model.bad):
            sizes.append(len(zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(content), write_content_size=False, write_dict_id=False).compress(raw)))
        n, (a, b) = max(len(raw), 1), sizes
        x = [(b - a) / n, (b - a) / max(a, b), a / n, b / n, math.log(1 + len(raw))]
        terms = [1.0, *x, *(x[i] * x[j] for i in range(5) for j in range(i, 5))]
        total = sum(w * (t - c) / s for w, t, c, s in zip(model.weights, terms, model.centre, model.spread, strict=True))
        assert got[r["doc_id"]] == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, total)))), abs=1e-9)


def test_long_and_empty_labelled_texts_are_learned(spark, documents):
    """Labels of long texts only, of which the beginnings are alike."""
    rng = random.Random(6)
    make = lambda words, n: " ".join(rng.choices(words, k=n))
    good, bad = ["river", "valley", "meadow", "forest", "winter"], ["klick", "bonus", "gratis", "casino", "jackpot"]
    rows = [(i, "same words at first " * 20 + make(good if i % 2 else bad, 400)) for i in range(120)]
    rows += [(200, ""), (201, None), (1, rows[1][1])]
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)] + [(200, 0), (201, 0)], "doc_id long, quality int")
    model = quality.fit(documents(rows), labels, max_chars=1_000)
    scores = model.score([make(good, 300), make(bad, 300)])
    assert scores[0] > 0.5 > scores[1]


def test_language_by_query_equals_all_paths(documents):
    """Each short text's language and score, by adding up the labels of its words over all paths."""
    rng = random.Random(9)
    letters = {"aa": "abcde", "ff": "cdefg", "zz": "efghi"}
    rows = [(i, " ".join("".join(rng.choices(letters[x], k=3)) for _ in range(rng.randrange(1, 6))), x) for i, x in enumerate([*letters] * 40)]
    docs = documents(rows)
    model = language.fit(language.training_rows(docs))
    got = {r["doc_id"]: r for r in language.op10_language_id(docs).collect()}
    n = len(model.labels)
    for i, text, _ in rows:
        words = language.words_of([text])
        scores = language._sums(words, model.weights)
        shares = np.zeros(n)
        for path in product(range(n), repeat=len(scores)):
            weight = math.exp(sum(scores[k, y] for k, y in enumerate(path)) + sum(model.moves[a, b] for a, b in zip(path, path[1:], strict=False)))
            for k, y in enumerate(path):
                shares[y] += weight * words.sizes[k]
        shares /= shares.sum()
        assert got[i]["lang_pred"] == model.labels[shares.argmax()] and got[i]["score"] == pytest.approx(shares.max(), abs=1e-6)


def test_language_of_held_out_documents(spark):
    docs = read(spark, FOLDER, "documents")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = language.op10_language_id(docs).collect()
    test = [r for r in rows if r["held_out"]]
    assert len(rows) == 1000 and all(r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in test]) > 0.95


def test_language_of_odd_texts(documents, odd_texts):
    rng = random.Random(1)
    make = lambda letters: " ".join("".join(rng.choices(letters, k=5)) for _ in range(20))
    rows = [*odd_texts, *((100 + i, make("aeiou"), "aa") for i in range(30)), *((200 + i, make("xyz"), "zz") for i in range(30)), (300, make("xyz"), None)]
    got = {}
    for r in language.op10_language_id(documents(rows)).collect():
        got.setdefault(r["doc_id"], r)
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 8)] == ["und"] * 4 and got[1]["score"] == 0
    assert got[200]["lang_pred"] == "zz" and got[300]["lang_pred"] == "zz" and got[110]["lang_pred"] == "aa"
    assert language.op10_language_id(documents([])).count() == 0


def test_every_language_is_learned(documents):
    """70 languages, and two whose texts are all too short or too long for the usual sample."""
    rng = random.Random(3)
    made = {f"l{k}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(6)] for k in range(70)}
    rows = [(1_000 * k + i, " ".join(rng.choices(words, k=12)), lang) for k, (lang, words) in enumerate(made.items()) for i in range(3)]
    rows += [(100_000 + i, "qoqo wuwu", "short") for i in range(3)] + [(200_000 + i, f"vyvy {i} kiki jeje " * 500, "long") for i in range(3)]
    model = language.fit(documents(rows))
    assert model.labels == sorted([*made, "short", "long"])
    assert model.predict(["qoqo wuwu", "kiki jeje vyvy", " ".join(made["l69"])])[0] == ["short", "long", "l69"]


def test_texts_that_switch_between_languages_are_accepted(documents):
    rng = random.Random(5)
    letters = {"aa": "abc", "ff": "fgh", "mm": "mno", "zz": "xyz"}
    make = lambda lang, n: " ".join("".join(rng.choices(letters[lang], k=4)) for _ in range(n))
    langs = [*letters] * 40
    model = language.train([make(x, 30) for x in langs], langs)
    mixed = " ".join(make(x, 20) for x in letters)
    assert model.predict([mixed])[1][0] < 0.35
    assert [r["doc_id"] for r in language.accepted(documents([(1, mixed), (2, "12 34")]), model).collect()] == [1]


#: Sentences in languages that the tables do not have, and letters at random.
UNLEARNED = {
    "fi": "Kissa nukkuu lämpimän uunin päällä ja näkee unta kaloista, kun lapset juoksevat pihalla ja äiti keittää kahvia keittiössä.",
    "ru": "Кошка спит на тёплой печи и видит сны о рыбе, пока дети бегают во дворе, а мать варит кофе на кухне.",
    "ja": "子供たちが庭で走り回り、母が台所でコーヒーをいれている間、猫は暖かい暖炉の上で魚の夢を見ています。",
    "el": "Η γάτα κοιμάται πάνω στη ζεστή σόμπα και ονειρεύεται ψάρια, ενώ τα παιδιά τρέχουν στην αυλή.",
}


def test_unlearned_languages_and_letter_salad_are_rejected(spark, documents):
    rng = random.Random(8)
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    model = language.fit(language.training_rows(docs))
    salad = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz" + " " * 5, k=400)) for _ in range(4)]
    held = [r["text"] for r in docs.where("pmod(crc32(cast(cast(doc_id as string) as binary)), 5) = 0 and n_chars > 100").collect()]
    by_lang = {r["lang"]: r["text"] for r in docs.where("n_chars between 300 and 3000").collect()}
    mixed = " ".join(t[:300] for t in by_lang.values())
    familiar = model.judged([*UNLEARNED.values(), *salad, mixed, *held])[2]
    assert (familiar[: len(UNLEARNED) + len(salad)] < language.LEAST_FAMILIAR).all(), familiar[:8]
    assert familiar[len(UNLEARNED) + len(salad)] > 0.9
    assert (familiar[len(UNLEARNED) + len(salad) + 1 :] >= language.LEAST_FAMILIAR).mean() > 0.99


def test_switching_words_are_labelled_one_by_one():
    rng = random.Random(5)
    make = lambda letters, n: " ".join("".join(rng.choices(letters, k=4)) for _ in range(n))
    langs = ["aa", "zz"] * 40
    model = language.train([make("abc", 30) if x == "aa" else make("xyz", 30) for x in langs], langs)
    words = language.words_of([make("abc", 10) + " " + make("xyz", 12)])
    best = model.marginals(words, words.counts).argmax(axis=1)
    assert best.tolist() == [0] * 10 + [1] * 12
    assert model.moves[0, 0] > model.moves[0, 1]


def test_marginals_equal_all_paths():
    rng = np.random.default_rng(3)
    words = language.words_of(["ab cde f gh", "x"])
    model = language.Crf(["p", "q"], rng.normal(size=(language.NOTHING + 1, 2)).astype(np.float32), rng.normal(size=(2, 2)))
    got = model.marginals(words, words.counts)
    scores = language._sums(words, model.weights)
    begin = 0
    for n in words.counts:
        own, total = np.zeros((n, 2)), 0.0
        for path in product(range(2), repeat=int(n)):
            weight = np.exp(sum(scores[begin + k, y] for k, y in enumerate(path)) + sum(model.moves[a, b] for a, b in zip(path, path[1:], strict=False)))
            total += weight
            for k, y in enumerate(path):
                own[k, y] += weight
        assert got[begin : begin + n] == pytest.approx(own / total)
        begin += n
