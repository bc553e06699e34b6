"""From raw documents to token ids: language, exact copies, near copies, benchmark passages, encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakestrata.llm import bpe, decontam, exactdup, langid, neardup
from lakestrata.llm.common import prepare, table
from lakestrata.session import configure, materialize

LEAST_SCORE = 0.3  # mean probability of the predicted language below which a document is rejected


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter or without a language that the network is sure enough of."""
    prepare(configure(spark))
    return langid.predict(docs, langid.train(docs), least_score=LEAST_SCORE)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest identifier of equal texts."""
    prepare(configure(spark))
    return exactdup.deduplicate(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by five-word shingles at a similarity of 0.8."""
    prepare(configure(spark))
    return neardup.deduplicate(docs, words=5, percent=80)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes documents that hold ten consecutive words of a benchmark item, or a whole shorter one."""
    prepare(configure(spark))
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with digests of ids and decoded text."""
    prepare(configure(spark))
    return bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language), ("exact_dedup", exact_copies), ("near_dedup", near_copies), ("decontamination", benchmark_passages),
          ("bpe", encoding)]
ORACLE_SQL = None  # SQL cannot express the learned stage; tests/llm/test_pipeline.py compares each stage with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written once before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
