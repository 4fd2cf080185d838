"""Queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from faunagrid.llm import bpe, fingerprints, html_text, lines, mixing, near, pii, quality, secrets, topk


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bpe_round_trip": bpe.op1_bpe_round_trip,
        "op2_quality_classifier": quality.op2_quality_classifier,
        "op3_source_mix": mixing.op3_source_mix,
        "op4_ngram_jaccard_join": near.op4_ngram_jaccard_join,
        "op5_pii_surrogates": pii.op5_pii_surrogates,
        "op6_html_main_text": html_text.op6_html_main_text,
        "op7_line_dedup": lines.op7_line_dedup,
        "op8_exact_topk": topk.op8_exact_topk,
        "op9_secret_scan": secrets.op9_secret_scan,
        "op10_lz_fingerprints": fingerprints.op10_lz_fingerprints,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_ngram_jaccard_join": near.OP4_SQL,
        "op7_line_dedup": lines.OP7_SQL,
        "op8_exact_topk": topk.OP8_SQL,
        "op9_secret_scan": secrets.OP9_SQL,
    }
