"""The registered queries of the operators, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm import bloom_lm, byte_bpe, decontaminate, language_id, license_scan, ngram_join, piece_bpe, quality_rules, sharding, spelling_variants, sql, token_alignment, token_counts, url_filter
from aerolake.llm.common import read_table


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.component_ids(read_table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = quality_rules.stored_ledger(read_table(spark, sf_dir, "documents"))
    return quality_rules.apply_policy(led).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "fail_bits", "policy")


def quality_rule_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.ablation(quality_rules.stored_ledger(read_table(spark, sf_dir, "documents")))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_table(spark, sf_dir, "documents"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score_documents(read_table(spark, sf_dir, "documents"),
                                    language_id.remainder(F.col("doc_id"), 7) != 2)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), shards=16)


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return byte_bpe.round_trip_digest(read_table(spark, sf_dir, "documents"),
                                      vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents") \
        .withColumn("held_out", language_id.remainder(F.col("doc_id"), 3) == 1)
    model = language_id.fit(docs.where(~F.col("held_out")))
    return language_id.identify(docs, model, keep=("doc_id", "held_out"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.link_statistics(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
                                           vocabulary("piece_bpe_32k.model"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(read_table(spark, sf_dir, "documents"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.round_trip_digest(read_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_ngram_join, op2_decontamination, op3_quality_rules, quality_rule_ablation, op4_license_scan, op5_lm_scoring, op6_url_filter, op7_sharding, op8_token_counts, op9_byte_bpe, op10_language_id,
        op11_token_alignment, op12_spelling_variants, op13_sentencepiece)}


def oracle_sql() -> dict[str, str]:
    return sql.statements()
