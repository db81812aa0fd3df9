"""Landing of raw snapshots: products and users per ISO week, carts per day."""

from __future__ import annotations

from collections.abc import Callable, Collection
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyroll.functions import calendar
from tallyroll.session import remove
from tallyroll.sources import versions, zones


def stamp_carts(carts: DataFrame, run_date: date) -> DataFrame:
    """Every cart carries the run date, whatever date it came with."""
    return carts.withColumn("date", F.lit(run_date.isoformat()))


def land_weekly(df: DataFrame, base: str, kind: str, run_date: date, force: bool = False) -> bool:
    """Replace the snapshot of the run date's ISO week if a refresh is due; says whether it did."""
    if not calendar.is_refresh_day(run_date, force):
        return False
    year, week, _ = run_date.isocalendar()
    zones.replace_partition(df, zones.zone(base, "raw", kind), {"iso_year": year, "iso_week": week})
    return True


def land_carts(carts: DataFrame, base: str, run_date: date) -> None:
    """Replace the cart snapshot of one day."""
    _land(stamp_carts(carts, run_date).withColumn("run_date", F.lit(run_date)), base, [run_date.isoformat()])


def land_carts_history(carts: DataFrame, base: str, undated: date | None = None) -> None:
    """Replace the cart snapshots of all days in ``carts`` at once; the day is the cart's own date.

    Carts without a date go to the day ``undated``; if none is given, one such cart is an error.
    """
    day = F.to_date("date")
    if undated is None:
        other = F.raise_error(F.concat(F.lit("cart without a date: "), F.coalesce(F.col("id").cast("string"), F.lit("no id")))).cast("date")
    else:
        other = F.lit(undated)
    dated = carts.withColumn("run_date", F.when(day.isNull(), other).otherwise(day))
    # In the order of days, so that a reader of a few days skips the other files; a day of any size is spread over the tasks.
    _land(dated.repartitionByRange("run_date", "id").sortWithinPartitions("run_date"), base)


def _land(carts: DataFrame, base: str, days: list[str] | None = None) -> None:
    """Write carts into a folder of their own and publish their days, found while writing unless given."""
    spark, path, folder, written = carts.sparkSession, zones.zone(base, "raw", "carts"), versions.new_folder(), Observation()
    staged = zones.zone(path, folder)
    try:
        carts.observe(written, F.collect_set("run_date").alias("days")).write.parquet(staged)
        found = days if days is not None else [day.isoformat() for day in written.get["days"]]
        versions.commit(spark, path, folder, found, {"": versions.files(spark, staged)})
    except BaseException:
        remove(spark, staged)
        raise


def landed_days(spark: SparkSession, base: str, first: date | None = None, last: date | None = None) -> list[date]:
    """Days with a cart snapshot, be it empty."""
    return sorted(map(date.fromisoformat, versions.current(versions.log(spark, zones.zone(base, "raw", "carts")), first, last)))


def read_carts(spark: SparkSession, base: str, first: date | None = None, last: date | None = None, only: Collection[date] | None = None) -> DataFrame:
    """Landed carts with their ``run_date``; of a range of days, or of some days, only those are read."""
    return versions.read(spark, zones.zone(base, "raw", "carts"), "", first, last, only)


def landings(spark: SparkSession, base: str, first: date, last: date) -> dict[date, str]:
    """For each landed day of a range what landing its snapshot is from."""
    found = versions.current(versions.log(spark, zones.zone(base, "raw", "carts")), first, last)
    return {date.fromisoformat(day): commit.folder for day, commit in found.items()}


def land_weekly_history(df: DataFrame, base: str, kind: str, make: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Replace the weekly snapshots of all weeks in ``df``, which names them in iso_year and iso_week.

    ``make`` turns rows into documents once they are dealt out to their weeks, so that what is derived is not shuffled.
    """
    zones.replace_partitions(df, zones.zone(base, "raw", kind), by=list(calendar.WEEK_KEY), make=make)
