"""Partitioned Parquet tables under one base URI.

    raw/users, raw/products      iso_year=…/iso_week=…     weekly snapshots

The other zones are versioned (``sources.versions``):

    raw/carts/run=…                                        one snapshot per day, sorted by day
    analytics/run=…/<metric>                               published metrics, sorted by day
    warehouse/<metric>/run=…                               keyed rows, appended only, sorted by day
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroll.sources.raw import MissingInput, empty, is_missing_path


def zone(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *parts])


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    missing: str = "error",
    only: Callable[[dict[str, str]], bool] | None = None,
    keys: int = 1,
) -> DataFrame:
    """Read a table, or ``only`` those of its partitions (by ``keys`` columns) whose values are accepted; files of others are not listed.

    With ``missing="empty"`` and a schema, an absent table reads as no rows, as does a table
    without an accepted partition.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    paths = [path]
    if only is not None:
        paths = [leaf for leaf, values in partitions(spark, path, keys) if only(values)]
        reader = reader.option("basePath", path)
    try:
        if paths:
            return reader.parquet(*paths)
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
    if missing == "empty" and schema is not None:
        return empty(spark, schema)
    raise MissingInput(f"no table at {path}" if only is None else f"no such partition at {path}")


def partitions(spark: SparkSession, path: str, keys: int = 1) -> list[tuple[str, dict[str, str]]]:
    """Partition folders of a table with that many keys, with their values, from the folders' names alone."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    pattern = hadoop.Path("/".join([path, *["*=*"] * keys]))
    found = pattern.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(pattern)
    folders = sorted(p.toString() for p in hadoop.FileUtil.stat2Paths(found)) if found else []
    return [(folder, dict(part.split("=", 1) for part in folder.split("/")[-keys:])) for folder in folders]


def between(key: str, first: date, last: date) -> Callable[[dict[str, str]], bool]:
    """Accepts partitions whose day lies in the range."""
    return lambda values: first.isoformat() <= values.get(key, "") <= last.isoformat()


def table_name(path: Column) -> Column:
    """Table name in a file path: the last segment above part files and ``key=value`` folders, without ``.parquet``."""
    table = F.regexp_replace(path, r"(/[^/=]+=[^/]*)*/part-[^/]*$", "")
    return F.regexp_replace(F.element_at(F.split(table, "/"), -1), r"\.parquet$", "")


def replace_partition(df: DataFrame, path: str, partition: Mapping[str, object]) -> None:
    """Overwrite exactly one partition, also when ``df`` has no rows.

    The partition values come from the caller; columns of those names are dropped.
    """
    leaf = "/".join(f"{key}={value}" for key, value in partition.items())
    df.drop(*partition).write.mode("overwrite").parquet(f"{path}/{leaf}")


def replace_partitions(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    order: Sequence[Column] = (),
    make: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Overwrite the partitions that ``df`` has rows for and leave the others alone.

    ``make`` turns the rows into those that are written, behind the shuffle; it keeps the partition columns.

    With an order, rows are range-partitioned by (partition, order): each file is sorted and a
    large partition is spread over many tasks. Without one, Spark rebalances by partition
    value, which also splits a large partition.
    """
    if order:
        df = df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    else:
        df = df.hint("rebalance", *by)
    df = make(df) if make else df
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
