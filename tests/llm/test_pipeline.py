"""The pipeline against a replay of its stages by plain means."""

import random

import corpus_pipeline
from basketflow.llm import language
from basketflow.llm.byte_bpe import codec
from basketflow.llm.common import read
from basketflow.llm.decontaminate import LEAST_CHARS, BUDGET, normalised
from basketflow.llm.secret_scan import redacted, spans, vocabulary
from tests.llm.test_decontaminate import plain_distance
from tests.llm.test_minhash_dedup import brute_force

FOLDER = "/root/testdata/sf0.001"


def test_run_equals_plain_replay(spark):
    docs = read(spark, FOLDER, "documents")
    model = language.fit(language.training_rows(docs))
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    langs, _, familiar = model.judged([t for _, t in rows])
    rows = [r for r, lang, share in zip(rows, langs, familiar, strict=True) if lang != "und" and share >= language.LEAST_FAMILIAR]
    rows = [r for r, (*_, kept) in zip(rows, brute_force(rows, 80), strict=True) if kept]
    items = [normalised(r["text"]) for r in read(spark, FOLDER, "benchmark").collect()]

    def leaks(text):
        text = normalised(text)
        if any(f" {t} " in f" {text} " for t in items if 0 < len(t) < LEAST_CHARS):
            return True
        return any(t in text or (len(text) < 3_000 and t[:30] in text and plain_distance(t, text) <= int(BUDGET * len(t))) for t in items if len(t) >= LEAST_CHARS)

    encoding = vocabulary()
    wanted = {}
    for i, text in rows:
        if not leaks(text):
            found = spans(text, encoding)
            wanted[i] = codec().encode(redacted(text, found) if found else text).tolist()
    assert {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, FOLDER).collect()} == wanted


def test_stages_take_odd_rows(spark, documents, odd_texts):
    docs = documents([*odd_texts, (50, "some words of a text that is kept by all"), (51, "Some words of a text that is kept by all")])
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == columns
    ids = sorted((r["doc_id"] for r in docs.select("doc_id").collect()), key=str)
    assert 50 in ids and 51 not in ids and ids.count(6) == 1 and None in ids and 1 not in ids and 8 not in ids
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert last.count() == len(ids)


def test_rows_that_share_an_id_keep_their_own_texts(spark, documents):
    """Nothing of another text is lost, and the same rows stay each time."""
    words = "the and of to in is that it for was on with as be by this are at from".split()
    rng = random.Random(2)
    one, two, three, four, five = (" ".join(rng.choices(words, k=60)) for _ in range(5))
    item = read(spark, FOLDER, "benchmark").first()["text"]
    rows = [(1, one), (2, one), (2, two), (3, three), (3, four), (3, f"{five} {item}"), (None, five), (None, f"{item} {five}")]
    for partitions in (1, 4):
        docs = documents(rows, partitions)
        for _, stage in corpus_pipeline.STAGES[1:4]:
            docs = stage(spark, docs, FOLDER)
        left = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=str)
        assert left == sorted([(1, one), (2, two), (3, three), (3, four), (None, five)], key=str)


def test_language_stage_judges_rows_and_fills_in_languages(spark, documents):
    docs = read(spark, FOLDER, "documents")
    known = [(r["doc_id"], r["text"]) for r in docs.where("lang = 'en' and length(text) > 200").limit(20).collect()]
    rows = [(i, t, None) for i, t in known] + [(known[0][0], "кошка спит на тёплой печи и видит сны"), (None, known[1][1])]
    model = language.fit(language.training_rows(docs))
    left = language.accepted(documents(rows), model).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in left), key=str) == sorted([*known, (None, known[1][1])], key=str)
    assert all(r["lang"] is not None for r in left)


def test_stages_take_empty_tables(spark, documents):
    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        assert docs.count() == 0
