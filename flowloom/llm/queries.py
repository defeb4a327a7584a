"""Registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm import (
    bpe,
    chat_format,
    common,
    decontaminate,
    language_id,
    merkle_manifest,
    near_dedup,
    page_text,
    periodic_runs,
    token_counts,
    topk_join,
    toxicity,
    url_filter,
    vector_dedup,
)

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable:
    def put(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        REGISTRY[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


@register("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(common.table(spark, sf_dir, "documents"), common.tokenizer_file())


@register("op5_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(common.table(spark, sf_dir, "documents"), common.tokenizer_file())


@register("op3_url_filter")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(common.table(spark, sf_dir, "pages"))


@register("op7_page_text")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract_text(common.table(spark, sf_dir, "pages"))


@register("op9_topk_join", topk_join.ORACLE)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_join.top_k(common.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@register("op10_chat_format", chat_format.ORACLE)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_chats(common.table(spark, sf_dir, "conversations"))


@register("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return toxicity.score_texts(docs, toxicity.learn(docs, common.table(spark, sf_dir, "labels")))


@register("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return language_id.predict_languages(docs, language_id.learn(docs))


@register("op4_decontaminate")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


@register("op1_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(common.table(spark, sf_dir, "documents"))


@register("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return periodic_runs.digests(periodic_runs.find_runs(docs, edit=periodic_runs.looped))


@register("op12_merkle_manifest", merkle_manifest.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.tampering_check(common.table(spark, sf_dir, "documents"))


@register("op13_vector_dedup", vector_dedup.ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(common.table(spark, sf_dir, "embeddings"))
