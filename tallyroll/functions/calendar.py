"""Run dates, ISO weeks and the weekly refresh rule."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEK_KEY = ("iso_year", "iso_week")


def iso_year(day: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), day).cast("int")


def iso_week(day: Column) -> Column:
    return F.weekofyear(day)


def week_label(day: Column) -> Column:
    """``week_<year>_<week>`` by ISO rules, the week not padded."""
    return F.concat_ws("_", F.lit("week"), iso_year(day).cast("string"), iso_week(day).cast("string"))


def day_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def refresh_due(day: Column, force: bool = False) -> Column:
    """Weekly snapshots are refreshed on Mondays, or on any day when forced."""
    return F.lit(True) if force else F.weekday(day) == F.lit(0)


def is_refresh_day(day: date, force: bool = False) -> bool:
    return force or day.weekday() == 0


def parse_day(text: str) -> date:
    return date.fromisoformat(text)
