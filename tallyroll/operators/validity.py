"""Weekly dimension snapshots as intervals of weeks in which a row did not change, and the join with them.

A snapshot repeats every row each week. Here the weeks in a row in which an id has the same attributes
become one row with its first and last week, so a dimension grows with its changes, not with the weeks.
Weeks are numbered; every ``EPOCH`` weeks an interval is cut, and the intervals of an id in an epoch form one row, of ``EPOCH`` intervals at most
for each copy of the id. A fact then meets that row by equality of id and epoch, whatever the
history's length, and keeps the intervals that hold its week: the same rows as a join on week and id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroll.functions import calendar
from tallyroll.operators.joins import BROADCAST_BYTES, lookup_join, measured_bytes

# Weeks after which intervals are cut.
EPOCH = 26
VALID = ("valid_from", "valid_to")


def week_number(year: Column, week: Column) -> Column:
    """Weeks from that of 5 January 1970, a Monday, to an ISO week; the fourth of January is in the first week."""
    fourth = F.make_date(year, F.lit(1), F.lit(4))
    return _number(fourth) + week - 1


def week_of(day: Column) -> Column:
    return _number(day)


def _number(day: Column) -> Column:
    return F.floor(F.datediff(day, F.lit("1970-01-05").cast("date")) / F.lit(7)).cast("int")


def intervals(weekly: DataFrame, key: str) -> DataFrame:
    """The rows of weekly snapshots with ``valid_from`` and ``valid_to`` in place of their week.

    Rows without an id go, since no join finds them. A row that a snapshot holds twice gives two intervals; a week without a
    snapshot, or without the id, ends them. The rows of an id are at most its weeks times its copies, so they can meet in a task.
    """
    fields = [c for c in weekly.columns if c not in calendar.WEEK_KEY]
    number = week_number(F.col("iso_year"), F.col("iso_week"))
    rows = weekly.where(F.col(key).isNotNull()).select(number.alias("_week"), *fields)
    copies = rows.groupBy("_week", *fields).agg(F.count(F.lit(1)).alias("_n"))
    each = copies.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n")))).drop("_n")
    place = F.row_number().over(Window.partitionBy(*fields, "_copy").orderBy("_week"))
    # Consecutive weeks have the same difference of week and place.
    runs = each.withColumn("_run", F.col("_week") - place).groupBy(*fields, "_copy", "_run")
    return runs.agg(F.min("_week").alias(VALID[0]), F.max("_week").alias(VALID[1])).select(*VALID, *fields)


def packed(valid: DataFrame, key: str) -> DataFrame:
    """One row for each id and epoch: ``_epoch``, the key, and ``_rows``, the intervals of that epoch with their fields."""
    fields = [c for c in valid.columns if c not in (*VALID, key)]
    epochs = F.sequence(F.floor(F.col(VALID[0]) / EPOCH), F.floor(F.col(VALID[1]) / EPOCH))
    return valid.select("*", F.explode(epochs).alias("_epoch")).groupBy("_epoch", key).agg(F.collect_list(F.struct(*VALID, *fields)).alias("_rows"))


def valid_join(
    fact: DataFrame, valid: DataFrame, key: str, spread_by: Sequence[str], day: str = "run_date", broadcast_bytes: int = BROADCAST_BYTES, profile: DataFrame | None = None, **join_options
) -> DataFrame:
    """``fact`` left join ``valid`` on the key and the week of ``day``; several matches multiply the row. Hot keys are looked for in ``profile`` where given."""
    week = week_of(F.col(day))
    numbers = {"_week": week, "_epoch": F.floor(week / F.lit(EPOCH))}
    dated = fact.withColumns(numbers)
    if profile is not None:
        join_options["profile"] = profile.withColumns(numbers)
    # Measured on the flat intervals, since arrays have no size of their own there.
    small = measured_bytes(valid) <= broadcast_bytes
    joined = lookup_join(dated, packed(valid, key), ["_epoch", key], spread_by, broadcast_bytes=broadcast_bytes if small else -1, **join_options)
    holds = F.filter("_rows", lambda r: F.col("_week").between(r[VALID[0]], r[VALID[1]]))
    fields = [c for c in valid.columns if c not in (*VALID, key)]
    return joined.withColumn("_row", F.explode_outer(holds)).select(*fact.columns, *(F.col(f"_row.{c}").alias(c) for c in fields))
