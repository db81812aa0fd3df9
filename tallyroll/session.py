"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# What one task reads of a shuffle. By default adaptive execution rather merges partitions until there is one for each core
# (up to 64 MB of compressed rows, some 20 times that in sorts and hash maps), so the memory of a task grows with the input.
TASK_BYTES = 4 << 20
# What one task reads of files. By default that grows with the input to 128 MB of Parquet, some ten million narrow rows, which
# a load sorts and a shuffle into many partitions holds in memory.
FILE_BYTES = 16 << 20
TASK_SETTINGS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES),
    "spark.sql.files.maxPartitionBytes": str(FILE_BYTES),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}
# Rows of the largest table for each shuffle partition, at most.
TASK_ROWS = 250_000
# What lies on disk at once. By default the files of a shuffle stay until the driver's garbage collector finds that no frame refers to
# them, which with a large driver is long after their query: a job of many queries piles up all its shuffles. Here they go when
# their query ends; a frame that is executed again makes them anew. Files in Zstandard take some two thirds of those in Snappy; a scan's size is
# estimated as twice its files', so that a table does not look fit for broadcast for being well packed.
DISK_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.fileCompressionFactor": "2.0",
}

# Adaptive execution picks the number of reduce tasks, splits skewed join partitions and
# balances partitioned writes. A shuffled join turns into a hash join, without sorting the
# fact, if every partition of the smaller side is found to be small. Executor sizes and the
# initial number of shuffle partitions belong to the submit command, since they depend on the
# cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Sums and products of bigints must fail rather than wrap.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    **TASK_SETTINGS,
    **DISK_SETTINGS,
}


def object_store_settings(endpoint: str, access_key: str, secret_key: str, path_style: bool = True) -> dict[str, str]:
    """Settings for an S3-compatible store, to pass at submit; the code itself only sees URIs."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.aws.credentials.provider": "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider",
    }


def build_session(app: str = "tallyroll", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _bytes(text: str) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", text.strip().lower()).groups()
    return int(number) << 10 * " kmgt".index(unit or " ")


def fit_tasks(spark: SparkSession, rows: int) -> None:
    """Settings of a session that was built elsewhere, so that tasks are as many as ``rows`` call for and none grows with the input.

    They say into how many tasks a shuffle is dealt, and hold from then on; a session that is set finer is left alone.
    What is no longer needed leaves the disk (``DISK_SETTINGS``).
    """
    partitions, sizes = "spark.sql.shuffle.partitions", {"spark.sql.adaptive.advisoryPartitionSizeInBytes": TASK_BYTES, "spark.sql.files.maxPartitionBytes": FILE_BYTES}
    for name, value in {**TASK_SETTINGS, **DISK_SETTINGS}.items():
        if name not in sizes or _bytes(spark.conf.get(name)) > sizes[name]:
            spark.conf.set(name, value)
    if int(spark.conf.get(partitions)) < (needed := math.ceil(rows / TASK_ROWS)):
        spark.conf.set(partitions, str(needed))


# All scratch folders of this process lie below one folder of this name.
_OWN = f"tallyroll-{uuid.uuid4().hex}"


def scratch_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, which every node sees.

    Only a local master, as in tests, may go without that setting; it then uses its warehouse folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{scratch_root(spark)}/{_OWN}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage: values that depend on the physical layout are fixed from here on,
    and a lost executor costs a re-read instead of a recomputation. The files stay until
    ``clear_scratch``, since only the caller knows when the result has been consumed; jobs that
    consume it themselves use ``settled``.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settled(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A ``settle`` whose files go when the block ends."""
    paths: list[str] = []

    def keep(df: DataFrame, label: str) -> DataFrame:
        paths.append(scratch_path(spark, label))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield keep
    finally:
        for path in paths:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whichever file system it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all scratch folders of this process. Results that still read them can't be used any more."""
    remove(spark, f"{scratch_root(spark)}/{_OWN}")
