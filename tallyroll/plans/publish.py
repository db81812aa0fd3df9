"""Materialising shared frames and publishing metric tables."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import date
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyroll.functions import money
from tallyroll.plans.metrics import METRICS, Metric
from tallyroll.session import remove
from tallyroll.sources import versions, zones

# Metric jobs over the rollups are short; a few at a time keep the executors busy (``side_by_side``).
PARALLEL_JOBS = 4


class MissingOutput(LookupError):
    """A published table lacks a day."""


class ChangedOutput(LookupError):
    """A published table holds other rows than its run wrote."""


class Staged(dict[str, int]):
    """Files of a table and their length; ``content``: number and digest of the rows that were written."""

    content = ""


def content(columns: Iterable[str]) -> Column:
    """Number and digest of rows, whatever their order: the exact sum of their hashes."""
    digest = F.coalesce(F.sum(F.xxhash64(*sorted(columns)).cast("decimal(28,0)")), F.lit(0))
    return F.concat_ws(":", F.count(F.lit(1)).cast("string"), digest.cast("string"))


@contextmanager
def materialised(*frames: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """Compute frames once for several uses and release them afterwards.

    Blocks go to memory, then disk; the block of a lost executor is computed again.
    """
    try:
        for frame in frames:
            frame.persist(StorageLevel.MEMORY_AND_DISK)
            frame.write.format("noop").mode("overwrite").save()
        yield frames
    finally:
        for frame in frames:
            frame.unpersist()


def run_jobs(jobs: Iterable[Callable[[], object]], parallel: int = PARALLEL_JOBS) -> None:
    """Run independent Spark jobs side by side; the first failure is raised."""
    with ThreadPoolExecutor(parallel) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()


def side_by_side(spark: SparkSession) -> int:
    """How many metric jobs to run at a time: fewer, the more tasks one has for each core.

    One whose tasks fill the cluster several times gains nothing from others beside it, and all their shuffles would lie on disk at once.
    """
    partitions = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return max(1, min(PARALLEL_JOBS, PARALLEL_JOBS * spark.sparkContext.defaultParallelism // partitions))


def _stage(result: DataFrame, folder: str, name: str) -> Staged:
    """Write a table; its content is counted on the way, without another pass."""
    path, written = zones.zone(folder, name), Observation()
    result.observe(written, content(result.columns).alias("content")).write.parquet(path)
    staged = Staged(versions.files(result.sparkSession, path))
    staged.content = written.get["content"]
    return staged


def stage_day(metric: Metric, sales: DataFrame, folder: str, run_date: date, places: money.Places = money.Places()) -> Staged:
    """Write one day of a metric into the folder of a run; its files."""
    result = metric.compute(sales, places=places)
    return _stage(result.select(F.lit(run_date).alias("run_date"), "*"), folder, metric.name)


def stage_days(metric: Metric, sales: DataFrame, folder: str, days: Sequence[date], places: money.Places = money.Places()) -> Staged:
    """Write the given days of a metric, in the order of days and within each day, into the folder of a run.

    Days are no folders: files are sorted by day, so a reader of a few days skips the others by the files' own statistics,
    and a history of any length has as many files as it has tasks. A day without rows has none,
    or one of NULL where the metric has no keys.
    """
    result = metric.compute(sales, by=("run_date",), ordered=False, places=places)
    if not metric.keys:
        all_days = sales.sparkSession.createDataFrame([(d,) for d in days], "run_date date")
        result = all_days.join(result, ["run_date"], "left")
    order = [F.col("run_date"), *metric.order()]
    return _stage(result.repartitionByRange(*order).sortWithinPartitions(*order), folder, metric.name)


def publish(spark: SparkSession, base: str, days: Iterable[date], stage: Callable[[Metric, str], dict[str, int]], metrics: Iterable[Metric] = METRICS.values(), marks: Mapping[date, str] | None = None) -> None:
    """Replace some days of all metric tables at once: ``stage`` writes a metric into the folder it is given.

    If one of them fails, no table changes. ``marks`` say what each day was computed from.
    """
    analytics, name, added = zones.zone(base, "analytics"), versions.new_folder(), {}
    folder = zones.zone(analytics, name)

    def one(metric: Metric) -> None:
        added[metric.name] = stage(metric, folder)

    try:
        run_jobs([lambda m=m: one(m) for m in metrics], side_by_side(spark))
        contents = {table: staged.content for table, staged in added.items() if isinstance(staged, Staged)}
        versions.commit(spark, analytics, name, [d.isoformat() for d in days], added, marks={d.isoformat(): mark for d, mark in (marks or {}).items()}, contents=contents)
    except BaseException:
        remove(spark, folder)
        raise


def check_day(spark: SparkSession, base: str, run_date: date) -> None:
    """Every metric table has its files for the day, be it without rows."""
    check_days(spark, base, [run_date])


def check_days(spark: SparkSession, base: str, days: Sequence[date]) -> None:
    """Each of ``days`` is published, and every metric table has the files that its run wrote, no other and of their length."""
    analytics = zones.zone(base, "analytics")
    found = versions.current(versions.log(spark, analytics))
    for day in sorted(days):
        if day.isoformat() not in found:
            raise MissingOutput(f"no files for {day}")
    for commit in {found[day.isoformat()].folder: found[day.isoformat()] for day in days}.values():
        for name in METRICS:
            there, written = versions.files(spark, zones.zone(analytics, commit.folder, name)), commit.files.get(name, {})
            if not written:
                raise MissingOutput(f"{name} has no files for {commit.days[0]} to {commit.days[-1]}")
            wrong = sorted(file for file in {*there, *written} if there.get(file) != written.get(file))
            if wrong:
                state = "is missing" if wrong[0] not in there else "was not written by its run" if wrong[0] not in written else "has another length"
                raise MissingOutput(f"{name}: {commit.folder}/{wrong[0]} {state}")


def contents(spark: SparkSession, base: str, days: Collection[date]) -> DataFrame:
    """``folder, table_name, written, found`` for the runs that ``days`` come from: number and digest of the rows of each table when
    it was written (null if its run did not say) and now. One pass over these runs' tables.
    """
    analytics, frames = zones.zone(base, "analytics"), []
    runs = {commit.folder: commit for commit in versions.current(versions.log(spark, analytics), only=days).values()}
    for folder, commit in sorted(runs.items()):
        for name in sorted(commit.files):
            table = spark.read.parquet(zones.zone(analytics, folder, name))
            said = F.lit(commit.contents.get(name)).cast("string")
            frames.append(table.agg(content(table.columns).alias("found")).select(F.lit(folder).alias("folder"), F.lit(name).alias("table_name"), said.alias("written"), "found"))
    if not frames:
        raise MissingOutput(f"no such day at {analytics}")
    return reduce(DataFrame.unionByName, frames)


def check_contents(spark: SparkSession, base: str, days: Sequence[date]) -> None:
    """``check_days``, and every table of the runs of ``days`` holds just the rows that were written."""
    check_days(spark, base, days)
    # A row for each run and table.
    for r in contents(spark, base, days).where(F.col("written") != F.col("found")).sort("folder", "table_name").collect():
        raise ChangedOutput(f"{r.table_name}: {r.folder} holds {r.found.split(':')[0]} rows, {r.written.split(':')[0]} were written" + (", with other values" if r.found.split(":")[0] == r.written.split(":")[0] else ""))


def read_published(spark: SparkSession, base: str, name: str, first: date, last: date, only: Collection[date] | None = None) -> DataFrame:
    """Published rows of a metric for a range of days, or some days of it, each day as its last run left it."""
    return versions.read(spark, zones.zone(base, "analytics"), name, first, last, only)


def published_marks(spark: SparkSession, base: str, first: date, last: date) -> dict[date, str | None]:
    """For each published day of a range what it was computed from, if its run said so."""
    found = versions.current(versions.log(spark, zones.zone(base, "analytics")), first, last)
    return {date.fromisoformat(day): commit.marks.get(day) for day, commit in found.items()}
