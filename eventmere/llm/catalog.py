"""The operators' queries by name, and the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventmere.llm import (
    alignment, leaks, merkle, near, personal, quality, rules, secrets, segments, substring, suffix_tree, token_store, warc,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One query per operator, over its whole table."""
    return {
        "op1_substring_dedup": substring.query,
        "op2_warc_index": warc.query,
        "op3_quality_classifier": quality.query,
        "op4_personal_data": personal.query,
        "op5_lm_scoring": suffix_tree.query,
        "op6_sampled_segments": segments.query,
        "op7_secret_scan": secrets.query,
        "op8_minhash_near_dedup": near.query,
        "op9_benchmark_leaks": leaks.query,
        "op10_quality_rules": rules.query,
        "op11_merkle_manifest": merkle.query,
        "op12_token_store": token_store.query,
        "op13_token_alignment": alignment.query,
    }


def oracle_sql() -> dict[str, str]:
    """SQL of the queries whose whole result SQL can express."""
    return {
        "op1_substring_dedup": substring.ORACLE_SQL,
        "op2_warc_index": warc.ORACLE_SQL,
        "op8_minhash_near_dedup": near.ORACLE_SQL,
        "op11_merkle_manifest": merkle.ORACLE_SQL,
    }
