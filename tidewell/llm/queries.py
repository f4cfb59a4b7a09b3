"""Queries of the numbered operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import byte_bpe, code_compression, exact_dedup, html_extraction, lm_scoring, ngram_join, packing, pii, prefix_trie, product_quantisation, quality_classifier, quality_rules, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": html_extraction.op1_html_extraction,
    "op2_lm_scoring": lm_scoring.op2_lm_scoring,
    "op3_quality_rules": quality_rules.op3_quality_rules,
    "op4_packing": packing.op4_packing,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_pii": pii.op7_pii,
    "op8_byte_bpe": byte_bpe.op8_byte_bpe,
    "op9_ngram_join": ngram_join.op9_ngram_join,
    "op10_quality_classifier": quality_classifier.op10_quality_classifier,
    "op11_embedding_near_dedup": product_quantisation.op11_embedding_near_dedup,
    "op12_code_compression": code_compression.op12_code_compression,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}

ORACLES: dict[str, str] = {
    "op5_exact_dedup": exact_dedup.SQL.strip(),
    "op9_ngram_join": ngram_join.SQL.strip(),
    "op11_embedding_near_dedup": product_quantisation.SQL.strip(),
    "op12_code_compression": code_compression.SQL.strip(),
    "op13_prefix_trie": prefix_trie.SQL.strip(),
}
