"""Queries and SQL of the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripmill.llm import embedding_dedup, exact_dedup, jaccard_join, language_id, lm_scores, merkle_manifest, packing, pieces, quality_rules, suffix_dedup, token_counts, tokenizer_alignment, toxicity

MODULES = (token_counts, toxicity, language_id, exact_dedup, packing, jaccard_join, embedding_dedup, suffix_dedup, pieces, lm_scores, quality_rules, tokenizer_alignment, merkle_manifest)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
