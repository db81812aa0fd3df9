"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.llm.bpe import bpe_digests
from tallyroll.llm.chat import chat_format
from tallyroll.llm.decontaminate import matches
from tallyroll.llm.language_model import score
from tallyroll.llm.license_scan import license_scan
from tallyroll.llm.merkle import merkle_digests
from tallyroll.llm.minhash import near_duplicates
from tallyroll.llm.prefix_trie import conversation_trie
from tallyroll.llm.quality import quality_rules
from tallyroll.llm.reference_sql import reference_sql
from tallyroll.llm.reference_sql_trees import OP11, OP12, OP13
from tallyroll.llm.substring import substring_dedup
from tallyroll.llm.suffix import suffix_dedup
from tallyroll.llm.tables import documents, reachable
from tallyroll.llm.url_filter import rule_table, url_filter
from tallyroll.llm.wordpiece import token_counts

# The rules of op11_url_filter as host, path and action.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir))


def op2_trigram_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid backoff with three words. ``op2_lm_scoring`` stays with the two words that its SQL defines."""
    found = score(documents(spark, sf_dir))
    return found.withColumns({"log_score": F.round("log_score", 4), "mean_log_score": F.round("mean_log_score", 6)})


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of logarithms depend on their order in the last digits, hence rounded."""
    found = score(documents(spark, sf_dir), order=2)
    return found.withColumns({"log_score": F.round("log_score", 4), "mean_log_score": F.round("mean_log_score", 6)})


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), max_bytes=None)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    reachable(spark)
    return chat_format(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(documents(spark, sf_dir))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(spark.read.parquet(f"{sf_dir}/pages.parquet"), rule_table(spark, URL_RULES))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_digests(documents(spark, sf_dir))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    reachable(spark)
    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def catalogue() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_suffix_dedup, op2_trigram_scoring, op2_lm_scoring, op3_substring_dedup, op4_token_counts, op5_quality_rules, op6_chat_formatting, op7_bpe, op8_decontamination, op9_license_scan, op10_minhash_dedup, op11_url_filter, op12_merkle_manifest, op13_prefix_trie)
    return {query.__name__: query for query in every}


def oracle_sql() -> dict[str, str]:
    return reference_sql() | {"op11_url_filter": OP11, "op12_merkle_manifest": OP12, "op13_prefix_trie": OP13}
