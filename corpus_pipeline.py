"""From raw documents to training tokens: five stages, each of which works on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basketflow.llm import byte_bpe, decontaminate, language, minhash_dedup, secret_scan
from basketflow.llm.common import read, told_apart, without
from basketflow.shared import as_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the languages of the corpus, mixed ones too; those without letters, in other languages or of random
    letters go. A missing language is filled in. Null texts go; rows that repeat an id are judged each by its text."""
    return language.accepted(docs, language.fit(language.training_rows(docs)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (similarity of 0.8 or more), the one with the smallest id.

    Rows that repeat an id or have none are judged each by its text; of those that agree in id and text one stays.
    """
    return minhash_dedup.one_of_each(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark within the budget of edits.

    Null texts hold none. Rows that repeat an id or have none are judged each by its text.
    """
    keyed, key = told_apart(docs)
    found = decontaminate.contaminated(keyed, read(spark, sf_dir, "benchmark"), id_col=key)
    return without(keyed, found.select("doc_id"), key).select(*docs.columns)


def secret_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets cut out of the texts, row by row; null texts stay null."""
    return secret_scan.cleaned(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digests that show that they decode to its text.

    The same worker encodes and decodes, so that a task holds one vocabulary. Null texts have no ids; every row has a
    result, also those that repeat an id or have none.
    """
    return byte_bpe.digests(byte_bpe.encode(docs, decoded=True), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("minhash_dedup", near_duplicates),
    ("decontamination", benchmark_free),
    ("secret_scan", secret_free),
    ("byte_bpe", tokens),
]

#: A trained language model decides the first stage, which SQL cannot express; the tests replay the stages instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table that the next stage reads."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = as_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
