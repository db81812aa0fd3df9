"""Files that lie in buckets of a key, and joins that don't shuffle them.

Spark knows buckets by the catalog only, so a folder has a catalog entry of its own while it is written or
read. The entry is external: dropping it leaves the files, and what knows the folder is the log of its table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def _drop(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def write(rows: DataFrame, path: str, key: str, n: int) -> None:
    """Write ``rows`` in ``n`` buckets of ``key``, sorted by it; one file each if they come in ``n`` hash partitions of the key."""
    spark, name = rows.sparkSession, f"staged_{uuid.uuid4().hex}"
    try:
        rows.write.format("parquet").bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(name)
    finally:
        _drop(spark, name)


@contextmanager
def opened(spark: SparkSession, paths: Sequence[str], columns: str, key: str, n: int) -> Iterator[list[DataFrame]]:
    """The folders as tables of ``columns`` (DDL) whose scans keep their buckets, as long as the block lasts."""
    names = [f"stored_{uuid.uuid4().hex}" for _ in paths]
    try:
        for name, path in zip(names, paths, strict=True):
            spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {n} BUCKETS LOCATION '{path}'")
        yield [spark.table(name) for name in names]
    finally:
        for name in names:
            _drop(spark, name)
