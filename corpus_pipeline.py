"""Corpus cleaning and packing: each stage works on what the one before it kept.

Defined cases: documents with null, empty or short texts fail the base rules and go in the first stage; of repeated
rows, and of rows equal in text, one stays; rows without doc_id stay where the rules of a stage keep them and
name no group of near duplicates; extra columns pass through all stages but the last, whatever they are called;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import exact_dedup, ngram_join, packing, pii, quality_rules
from tidewell.llm.common import read_table, staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie in the perplexity band of their language."""
    return quality_rules.reject(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the greatest id."""
    return exact_dedup.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of word shingles connect, the one with the least id."""
    return ngram_join.keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the name of its kind."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("exact_dedup", exact_copies),
    ("ngram_join", near_copies),
    ("pii", personal_data),
    ("packing", packed),
]

# Perplexities, decoded spans and packing are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over ``documents``; each stage is written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
