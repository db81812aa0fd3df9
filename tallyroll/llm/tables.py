"""How the operators read a table: only the columns they name, nulls given a place."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NO_ID = -(2**63)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """``doc_id, id, h, text``: what identifies a row, and its text.

    ``id`` orders rows: a null id comes before all others; the smallest long, -2**63, counts as null. ``h`` is a hash of the text. Rows
    that agree in id and text are one document that is listed more than once; every result
    holds for each of its rows. A null text is empty.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    doc_id = F.col(f"`{id_col}`").cast("long")
    return docs.select(
        doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("h"), text.alias("text"), *more
    )


def text_place(docs: DataFrame, text_col: str) -> str:
    """Where ``numbered`` has the text: in its own place if it is a string there, else in ``text``."""
    return f"c{docs.columns.index(text_col)}" if dict(docs.dtypes)[text_col] == "string" else "text"


def numbered(docs: DataFrame, text_col: str, *more: Column) -> DataFrame:
    """All columns as ``c0, c1, ...``, so that no name clashes; the text is not sent to Python twice."""
    own = [F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(docs.columns)]
    cast = [F.col(f"`{text_col}`").cast("string").alias("text")] if text_place(docs, text_col) == "text" else []
    return docs.select(*own, *cast, *more)


def renamed(found: DataFrame, docs: DataFrame, *more: str) -> DataFrame:
    """The columns of ``docs`` out of what ``numbered`` made of them, by their own names, whatever these are; and others."""
    return found.select(*(F.col(f"c{i}").alias(name) for i, name in enumerate(docs.columns)), *more)


def reachable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if it isn't installed."""
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(p for p in (*paths, root) if p)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
