"""Corpus pipeline: quality rules, language identification, near-duplicate join, decontamination, byte-level BPE.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps with the columns of ``docs``; the last
returns token digests. ``run`` writes each stage's result to the shared folder and reads it again, so a lost executor
costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm import byte_bpe, decontaminate, language_id, ngram_join, quality_rules
from aerolake.llm.common import read_table, written
from aerolake.llm.queries import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the current policy fails."""
    whole = docs.select(F.struct("*").alias("__row"), F.col("text").alias("__body"))
    return quality_rules.judge(whole, text="__body", keep=("__row",)).where("kept").select("__row.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; the model learns from two thirds of the labelled documents. Where no
    document has a label, nothing is learned and all stay."""
    model = language_id.fit(docs.where(language_id.remainder(F.col("doc_id"), 3) != 1))
    if not model:
        return docs
    whole = docs.select(F.struct("*").alias("__row"), F.col("text").alias("__body"))
    return language_id.identify(whole, model, keep=("__row",), text="__body") \
        .where(F.col("lang_pred") != language_id.UNDETERMINED).select("__row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near duplicates."""
    return ngram_join.one_per_component(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.remove_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded bytes of every document."""
    import public_tokenizers
    return byte_bpe.round_trip_digest(docs, vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality rules", quality), ("language identification", language), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", benchmark), ("byte-level BPE", tokens)]

# Language models and merges by rank are not expressible in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline")
    return docs
