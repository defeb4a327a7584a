"""A training corpus from raw documents: language, toxicity, near copies, benchmark leaks, tokens.

Each stage takes what the one before has kept, written as Parquet, and returns the
columns of documents; the last returns the encoded documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowloom.llm import bpe, common, decontaminate, language_id, near_dedup, toxicity
from flowloom.session import new_table_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and texts of no clear language."""
    return language_id.keep_identified(docs, language_id.learn(docs))


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents predicted toxic."""
    return toxicity.keep_clean(docs, toxicity.learn(docs, common.table(spark, sf_dir, "labels")))


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each class of near copies."""
    return near_dedup.representatives(docs)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate.without_leaks(docs, common.table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, hashes of ids and decoded text, token_ids."""
    return bpe.encode_texts(docs, common.tokenizer_file(), keep_ids=True, kept_words=100_000, forget=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Rows sent to Python at once: long texts make the default of 10,000 rows hundreds of megabytes on both sides.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch", "1000"


def in_small_batches(stage: Stage) -> Stage:
    """The stage under BATCH. Spark reads it when the result is computed, so it stays in the session; `run` restores it."""
    def small(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(*BATCH)
        return stage(spark, docs, sf_dir)

    return small


STAGES: list[tuple[str, Stage]] = [
    ("language_id", in_small_batches(identify_language)),
    ("toxicity", in_small_batches(remove_toxic)),
    ("near_dedup", in_small_batches(remove_near_copies)),
    ("decontaminate", in_small_batches(remove_leaks)),
    ("bpe", in_small_batches(encode)),
]

#: Learned models and signatures are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`.

    Rows with a null id are kept like others until near copies, where a group keeps one document; texts without a
    letter, null ones too, go with the first stage. Repeated rows are near copies. An empty table gives an empty result.
    """
    docs = common.table(spark, sf_dir, "documents")
    before = spark.conf.get(BATCH[0])
    try:
        for name, stage in STAGES:
            path = new_table_path(spark, f"corpus-{name}")
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
    finally:
        spark.conf.set(BATCH[0], before)
    return docs
