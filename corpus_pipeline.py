"""The training-data pipeline: documents in, token digests of the documents that stay out.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; all but the
last return the columns of ``documents``. Between stages the rows are written as Parquet and read
again, so that a lost executor costs no more than a stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyroll.llm.bpe import bpe_digests
from tallyroll.llm.decontaminate import keep_unseen
from tallyroll.llm.minhash import keep_one
from tallyroll.llm.quality import keep_good
from tallyroll.llm.substring import cut_passages
from tallyroll.llm.tables import documents, reachable
from tallyroll.session import settle


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id."""
    return keep_one(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words and more that a document with a smaller id has are cut out."""
    return cut_passages(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return keep_unseen(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and hashes of the tokens of what is left."""
    return bpe_digests(docs)


def _stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        reachable(spark)
        return work(spark, docs, sf_dir)

    return stage


STAGES = [(work.__name__, _stage(work)) for work in (quality, near_duplicates, passages, decontamination, tokens)]

# The stages hash, align and tokenize, which SQL cannot express; tests/llm has a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
