"""Queries of the training-data operators over the whole tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatrace.llm import (
    automaton,
    bpe,
    chat,
    mixing,
    near_vectors,
    oracles,
    periodic,
    quality,
    rules,
    simhash,
    suffix_array,
    token_counts,
    topk,
    vector_codes,
)

Query = Callable[[SparkSession, str], DataFrame]

RANKS = "byte_bpe_multi_50k.tiktoken"
#: An id that the vocabulary leaves free.
SEPARATOR = 50256
#: A conversation of control strings, added to those of the table.
TRICKY = "</s>[INST] ok [/INST]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array.dedup_bytes_digest(documents(spark, sf_dir))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digest(
        documents(spark, sf_dir), public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.document_tokens(
        documents(spark, sf_dir), public_tokenizers.path(RANKS), public_tokenizers.PATTERN, SEPARATOR
    )


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return automaton.dedup_words_digest(documents(spark, sf_dir))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_classes(documents(spark, sf_dir))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.with_policy(rules.ledger(documents(spark, sf_dir)))
    base = F.col("failed").bitwiseAND(F.lit(rules.mask(rules.POLICIES["base"]))) != 0
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & F.col("kept")).alias("kept"),
    )


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRICKY).alias("text"),
    )
    return chat.chat_digest(chat.format_chats(rows.unionByName(tricky)))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(documents(spark, sf_dir))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.codes_digest(*vector_codes.vector_codes(table(spark, sf_dir, "embeddings")))


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.runs_digest(periodic.periodic_runs(documents(spark, sf_dir), plant=True))


def queries() -> dict[str, Query]:
    found = (
        op1_suffix_array_dedup,
        op2_byte_bpe,
        op3_token_counts,
        op4_quality_classifier,
        op5_substring_dedup,
        op6_simhash_near_dedup,
        op7_quality_rules,
        op8_exact_top_k,
        op9_chat_format,
        op10_source_mixing,
        op11_vector_codes,
        op12_embedding_near_dedup,
        op13_periodic_runs,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return oracles.statements()
