"""Cart lines with product and buyer attributes, one row per line and match."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.functions import calendar
from tallyroll.operators.flatten import LINE_IDENTITY
from tallyroll.operators.joins import lookup_join
from tallyroll.operators.validity import VALID, valid_join

PRODUCT_FIELDS = ("category", "price", "count", "rate")
USER_FIELDS = ("city", "email", "firstname", "lastname")


class MissingSnapshot(LookupError):
    """Some days have no weekly snapshot of a dimension."""


def dedupe(dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row per key, the smallest by its other fields, so that re-runs agree."""
    rest = [name for name in dim.columns if name not in on]
    return (
        dim.groupBy(*on).agg(F.min(F.struct(*rest)).alias("row")).select(*on, *[F.col(f"row.{n}").alias(n) for n in rest])
    )


def time_key(dim: DataFrame, weekly: bool) -> tuple[str, ...]:
    """Columns that say when a row of a dimension holds: none, its week, or its interval of weeks."""
    if not weekly:
        return ()
    return VALID if set(VALID) <= set(dim.columns) else calendar.WEEK_KEY


def time_join(fact: DataFrame, dim: DataFrame, key: str, weekly: bool, spread_by: Sequence[str] = LINE_IDENTITY, **join_options) -> DataFrame:
    """``fact`` left join ``dim`` on the key, and on the week of ``run_date`` if the dimension has weeks or intervals of them."""
    time = time_key(dim, weekly)
    if time == VALID:
        return valid_join(fact, dim, key, spread_by, **join_options)
    return lookup_join(with_week(fact) if weekly else fact, dim, [*time, key], spread_by, **join_options)


def product_dim(products: DataFrame, fields: Sequence[str] = PRODUCT_FIELDS, weekly: bool = False) -> DataFrame:
    """Flat products keyed for the join with sale lines."""
    return products.select(*time_key(products, weekly), F.col("Product_ID").alias("product_ID"), *fields)


def user_dim(users: DataFrame, fields: Sequence[str] = USER_FIELDS, weekly: bool = False) -> DataFrame:
    """Flat users keyed for the join with sale lines."""
    return users.select(*time_key(users, weekly), "User_ID", *fields)


def with_week(df: DataFrame, day: str = "run_date") -> DataFrame:
    return df.withColumns({"iso_year": calendar.iso_year(F.col(day)), "iso_week": calendar.iso_week(F.col(day))})


def enrich(
    lines: DataFrame,
    products: DataFrame,
    users: DataFrame,
    by: Sequence[str] = (),
    weekly: bool = False,
    dedupe_dims: bool = False,
    **join_options,
) -> DataFrame:
    """The wide fact: sale lines ⟕ products ⟕ users.

    Lines without a match keep NULL attributes, and an id that occurs twice in a dimension
    doubles its lines unless ``dedupe_dims``. ``weekly`` joins on the ISO week of ``run_date`` too; the
    dimensions have a row for each week, or for each interval of weeks (``operators.validity``).
    """
    product_rows, user_rows = product_dim(products, weekly=weekly), user_dim(users, weekly=weekly)
    if dedupe_dims:
        product_rows = dedupe(product_rows, [*time_key(products, weekly), "product_ID"])
        user_rows = dedupe(user_rows, [*time_key(users, weekly), "User_ID"])
    wide = time_join(lines, product_rows, "product_ID", weekly, **join_options)
    # Hot keys are looked for in the lines, not in their join with the products, which would have to be made for that.
    profile = lines if time_key(users, weekly) == VALID or not weekly else with_week(lines)
    wide = time_join(wide, user_rows, "User_ID", weekly, profile=profile, **join_options)
    return wide.select(*by, *PRODUCT_FIELDS, "User_ID", "product_ID", "quantity", *USER_FIELDS)
