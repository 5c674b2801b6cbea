"""A corpus pipeline of five stages over ``documents``; each stage's result is written and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import codec, decontaminate, jaccard_join, line_dedup, perplexity
from corvane.llm.rows import fresh
from corvane.scale import materialize
from corvane.ship import ship


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or their language's perplexity band reject go."""
    return perplexity.keep(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of nearly equal lines the first stays; ``n_chars`` follows the text.

    A document that had words and lost them all repeats others from end to end and goes;
    documents without words, which had nothing to lose, stay as they are.
    """
    word = r"[^\x20\x09-\x0D]"
    had = fresh(docs, "__had_words")
    marked = docs.withColumn(had, F.coalesce(F.col("text").rlike(word), F.lit(False)))
    out = line_dedup.dedup(marked)
    out = out.filter(~F.col(had) | F.col("text").rlike(word))
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", size)
    return out.select(*docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return jaccard_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.clean(docs, benchmark)


def bpe_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text of each document."""
    return codec.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("bpe_codec", bpe_codec),
]

#: SQL cannot say the language model or the byte-pair merges; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(ship(spark), docs, sf_dir), name)
    return docs
