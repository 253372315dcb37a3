"""Registered queries of the corpus operators and their DuckDB statements.

Each query applies its operator with production parameters to its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aloft.llm import (byte_bpe, debruijn, decontaminate, hard_negatives, langid, line_dedup, lyndon, mixing, near_dedup,
                       nn_descent, ranked_search, tokens, url_filter)
from aloft.llm.common import table
from aloft.llm.oracle_sql import ORACLE_SQL


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.report(table(spark, sf_dir, "embeddings"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.report(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.report(table(spark, sf_dir, "documents"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lyndon.report(table(spark, sf_dir, "documents"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.report(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, url_filter.rule_table(spark)).select(
        "page_id", "host", "path", "rule", "verdict")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(hard_negatives.relabelled(table(spark, sf_dir, "embeddings")))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.report(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_mixing": op3_mixing,
    "op4_language_id": op4_language_id,
    "op5_token_counts": op5_token_counts,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_url_filter": op9_url_filter,
    "op10_line_dedup": op10_line_dedup,
    "op11_ranked_search": op11_ranked_search,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_byte_bpe": op13_byte_bpe,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
