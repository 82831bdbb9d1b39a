"""The queries of this package, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from basketflow.llm import (
    byte_bpe,
    cross_tokenizer,
    decontaminate,
    hard_negatives,
    hmm_lm,
    language,
    line_dedup,
    minhash_dedup,
    pii,
    quality,
    secret_scan,
    substring_dedup,
    vector_dedup,
)
from basketflow.llm.common import read
from basketflow.llm.oracles import ORACLES as SQL

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op2_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_dedup.link_documents(read(spark, folder, "documents"), minhash_dedup.CLOSE)


def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.digests(byte_bpe.encode(read(spark, folder, "documents"), decoded=True))


def op4_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dedup.link_vectors(read(spark, folder, "embeddings"))


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scan(read(spark, folder, "documents")))


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.digests(substring_dedup.remove_repeats(read(spark, folder, "documents")))


def op7_hmm_lm(spark: SparkSession, folder: str) -> DataFrame:
    return hmm_lm.score(read(spark, folder, "documents"))


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digests(pii.find(read(spark, folder, "documents")))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.op9_quality(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.op10_language_id(read(spark, folder, "documents"))


def op11_cross_tokenizer(spark: SparkSession, folder: str) -> DataFrame:
    return cross_tokenizer.digests(cross_tokenizer.align(read(spark, folder, "documents")))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.op12_hard_negatives(read(spark, folder, "embeddings"))


def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.digests(line_dedup.drop_shared_lines(read(spark, folder, "documents")))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_decontaminate,
        op2_minhash_dedup,
        op3_byte_bpe,
        op4_vector_dedup,
        op5_secret_scan,
        op6_substring_dedup,
        op7_hmm_lm,
        op8_pii,
        op9_quality,
        op10_language_id,
        op11_cross_tokenizer,
        op12_hard_negatives,
        op13_line_dedup,
        pipeline,
    )
}
#: The others are not SQL's to express; tests compare them with brute force, exact round trips or held-out labels.
ORACLES: dict[str, str] = dict(SQL) if corpus_pipeline.ORACLE_SQL is None else {**SQL, "pipeline": corpus_pipeline.ORACLE_SQL}
