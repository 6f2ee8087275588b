"""Queries of the training-data operators, and the SQL that some of them can be held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkurate.llm import bpe, langid, lm, mixing, mpeg, neardup, prefixtrie, quality, syncmers, tokencount, toxicity, whitening, wrappers


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": quality.op1_quality_rules,
        "op2_language_id": langid.op2_language_id,
        "op3_mpeg_audio": mpeg.op3_mpeg_audio,
        "op4_lm_scoring": lm.op4_lm_scoring,
        "op5_html_extraction": wrappers.op5_html_extraction,
        "op6_near_duplicates": neardup.op6_near_duplicates,
        "op7_byte_bpe": bpe.op7_byte_bpe,
        "op8_source_mixing": mixing.op8_source_mixing,
        "op9_token_counts": tokencount.op9_token_counts,
        "op10_toxicity": toxicity.op10_toxicity,
        "op11_prefix_trie": prefixtrie.op11_prefix_trie,
        "op12_embedding_whitening": whitening.op12_embedding_whitening,
        "op13_document_fingerprints": syncmers.op13_document_fingerprints,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": quality.oracle(), "op8_source_mixing": mixing.oracle()}
