"""Keyed, re-runnable append of metric rows to warehouse tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroll.functions import calendar, keys
from tallyroll.operators.numbering import number_rows
from tallyroll.plans.metrics import Metric
from tallyroll.session import remove, settle
from tallyroll.sources import versions, zones
from tallyroll.sources.buckets import opened
from tallyroll.sources.buckets import write as write_buckets
from tallyroll.sources.raw import MissingInput, empty

KEY = ("static_date", "date_id")
KEY_COLUMNS = "date_id string, static_date string"
# Stored files up to this size in all are broadcast, keys only, when a table in buckets is loaded.
SMALL_BYTES = 16 << 20
# A table of positions per day up to this many days is broadcast (about 50 bytes each).
BROADCAST_DAYS = 100_000


def position_rows(metric: Metric, rows: DataFrame, keep: Callable[[DataFrame, str], DataFrame] = settle) -> DataFrame:
    """Rows keyed by day and position in the metric's order: ``date_id``, ``static_date``, fields."""
    numbered = number_rows(rows, ["run_date"], metric.order(), keep=keep)
    day = calendar.day_label(F.col("run_date"))
    return numbered.select(
        keys.position_key(day, F.col("row_no")).alias("date_id"),
        day.alias("static_date"),
        *[c for c in rows.columns if c != "run_date"],
    )


def content_rows(rows: DataFrame, buckets: int = 0) -> DataFrame:
    """Rows keyed by day and the hash of their fields.

    With ``buckets`` they come in so many hash partitions of the key, as a load in buckets wants them. The fields alone are
    shuffled: the key, most of a row's bytes, is taken from them before and again behind the shuffle.
    """
    fields = [c for c in rows.columns if c != "run_date"]
    day = calendar.day_label(F.col("run_date"))
    key = F.concat(day, F.lit("_"), keys.content_key(fields))
    dealt = rows.repartition(buckets, key) if buckets else rows
    return dealt.select(key.alias("date_id"), day.alias("static_date"), *fields)


def fresh_rows(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows whose key is not stored yet; what is stored stays as it was.

    ``date_id`` tells its day, so the join is on it alone: rows that come in hash partitions of it (``content_rows``) are not shuffled
    again. The stored keys are shuffled packed.
    """
    packed = stored.where(F.col("static_date").isNotNull()).select(keys.packed_key(F.col("date_id")).alias("_packed"))
    known = packed.repartition(keys.unpacked_key(F.col("_packed"))).select(keys.unpacked_key(F.col("_packed")).alias("date_id"))
    return rows.join(known, "date_id", "left_anti").select(*rows.columns)


def fresh_positions(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """The same for rows keyed by position.

    The stored positions of a day are 1 to n unless the table was changed by hand, so a row is
    new if its position is beyond n: one small aggregate instead of a join of all keys. A gap is
    looked for first, and the keys are joined if there is one.
    """
    position = F.element_at(F.split("date_id", "_"), -1).cast("bigint")
    per_day = stored.groupBy("static_date").agg(F.count(F.lit(1)).alias("_n"), F.max(position).alias("_last"), F.count_distinct(position).alias("_different"))
    per_day = per_day.persist()
    try:
        counts = per_day.agg(F.count(F.lit(1)).alias("days"), F.count_if(F.expr("_n <> _last OR _different <> _n")).alias("gaps")).first()
    finally:
        per_day.unpersist()
    if counts.gaps:
        return fresh_rows(rows, stored)
    ends = per_day.select("static_date", "_n")
    if counts.days <= BROADCAST_DAYS:
        ends = F.broadcast(ends)
    joined = rows.join(ends, "static_date", "left")
    return joined.where(position > F.coalesce("_n", F.lit(0))).select(*rows.columns)


def after_load(rows: DataFrame, stored: DataFrame, by_content: bool = True) -> DataFrame:
    """The table as a load leaves it, columns matched by name."""
    return stored.unionByName((fresh_rows if by_content else fresh_positions)(rows, stored))


def read_stored(
    rows: DataFrame, path: str, first: date | None = None, last: date | None = None, commits: Sequence[versions.Commit] | None = None
) -> DataFrame:
    """The stored table with the columns of ``rows``, or its days from ``first`` to ``last``; no rows if it does not exist yet.

    Only what has been committed, now or as of ``commits``; loads without one of those days are not listed.
    """
    spark = rows.sparkSession
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    low, high = first.isoformat() if first else "", last.isoformat() if last else "9999-12-31"
    found = versions.log(spark, path) if commits is None else commits
    paths = [zones.zone(path, commit.folder) for commit in found if any(low <= day <= high for day in commit.days)]
    if not paths:
        return empty(spark, schema)
    table = spark.read.schema(schema).parquet(*paths)
    return table if first is None and last is None else table.where(F.col("static_date").between(low, high))


def read_warehouse(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A stored metric table as it is now."""
    path = zones.zone(base, "warehouse", name)
    commits = versions.log(spark, path)
    if not commits:
        raise MissingInput(f"no table at {path}")
    return spark.read.parquet(*(zones.zone(path, commit.folder) for commit in commits))


def fresh_keys(rows: DataFrame, path: str, commits: Sequence[versions.Commit], first: date, last: date, buckets: int, tables: Sequence[DataFrame], small_bytes: int = SMALL_BYTES) -> DataFrame:
    """The same for rows of any key against a table in buckets; ``tables`` are the opened folders of ``in_buckets``.

    ``rows`` are shuffled once, into as many partitions as there are buckets; the stored keys are not. Folders that are not in these buckets meet the
    rows by broadcast, up to ``small_bytes`` of files, else by an ordinary join.
    """
    spark, fresh = rows.sparkSession, rows
    low, high = first.isoformat(), last.isoformat()
    bucketed = in_buckets(commits, first, last, buckets, small_bytes)
    others = [c for c in _holding(commits, first, last) if c not in bucketed]
    sizes, chosen, left = [sum(c.files[""].values()) for c in others], [], small_bytes
    for commit, size in sorted(zip(others, sizes, strict=True), key=lambda pair: pair[1]):
        if size <= left:
            chosen.append(commit)
            left -= size
    known = list(tables)
    for group, hint in ((chosen, True), ([c for c in others if c not in chosen], False)):
        if group:
            stored = spark.read.schema(KEY_COLUMNS).parquet(*(zones.zone(path, c.folder) for c in group))
            known.append(F.broadcast(stored) if hint else stored)
    for stored in known:
        fresh = fresh.join(stored.where(F.col("static_date").between(low, high)).select("date_id"), "date_id", "left_anti")
    return fresh.select(*rows.columns)


def _holding(commits: Sequence[versions.Commit], first: date, last: date) -> list[versions.Commit]:
    low, high = first.isoformat(), last.isoformat()
    return [commit for commit in commits if any(low <= day <= high for day in commit.days)]


def in_buckets(commits: Sequence[versions.Commit], first: date, last: date, buckets: int, small_bytes: int = SMALL_BYTES) -> list[versions.Commit]:
    """Loads of those days that are in so many buckets and not small."""
    return [c for c in _holding(commits, first, last) if c.buckets == buckets and sum(c.files[""].values()) > small_bytes]


def load(rows: DataFrame, path: str, first: date, last: date, by_content: bool = True, buckets: int = 0, small_bytes: int = SMALL_BYTES) -> None:
    """Create the table if absent, then append the rows whose key it lacks.

    Only loads with days from ``first`` to ``last`` are listed, and only those days read: files are sorted by day. ``by_content=False`` is
    for rows keyed by position. Loads may run side by side: the new rows are staged in a folder of this load and
    published in one step (``sources.versions``). If another load has published one of the same days meanwhile, the staged rows go and
    are determined anew against what is stored then, so every key comes once.

    With ``buckets`` the new rows are written in so many buckets of their key, in which later loads of as many find them without a shuffle of the
    stored keys (``fresh_keys``); for tables whose loads are large. The number should stay the same from load to load, and be some
    multiple of the cores; loads with another number or none are found as well.
    """
    spark = rows.sparkSession
    while True:
        seen, folder = versions.log(spark, path), versions.new_folder()
        staged, written = zones.zone(path, folder), Observation()
        paths = [zones.zone(path, c.folder) for c in in_buckets(seen, first, last, buckets, small_bytes)] if buckets else []
        with opened(spark, paths, KEY_COLUMNS, "date_id", max(1, buckets)) as tables:
            if buckets:
                # In the buckets' partitions already, unless nothing in buckets was stored yet.
                fresh = fresh_keys(rows, path, seen, first, last, buckets, tables, small_bytes).repartition(buckets, "date_id")
            else:
                fresh = (fresh_rows if by_content else fresh_positions)(rows, read_stored(rows, path, first, last, seen))
            fresh = fresh.observe(written, F.collect_set("static_date").alias("days"))
            try:
                if buckets:
                    write_buckets(fresh, staged, "date_id", buckets)
                else:
                    # Rows keyed by position come in the order of their days, which is kept.
                    fresh.sortWithinPartitions("static_date").write.parquet(staged)
                days = set(written.get["days"])
                added = {"": versions.files(spark, staged)}
                done = not days or versions.commit(spark, path, folder, days, added, seen, lambda other, days=days: not days.isdisjoint(other.days), buckets=buckets)
            except BaseException:
                remove(spark, staged)
                raise
        if not days or not done:
            remove(spark, staged)
        if done:
            return
