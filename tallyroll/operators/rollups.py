"""Additive measures per product and per buyer, the two tables behind all metrics.

Every metric sums something over the enriched lines, grouped either by product attributes or
by buyer attributes. Lines are therefore counted per product id, and valued per buyer id,
before the attributes are joined:

* per product, the fact is aggregated without any join; price, rating and category meet one
  row per product;
* per buyer, each line needs its price, and only that column of the products is joined to the
  lines; buyer attributes meet one row per buyer.

The aggregation before the shuffle leaves one row per key and task, so a hot product or buyer
is no hot task, and the wide enriched fact is never built.

The measures are the same as those of single lines (``line_measures``), and since they are
additive both ways give the same metrics, also where a dimension repeats an id.

Counting per id first pays if the rollup serves several metrics or if a metric is per id. A
single metric per category or city (``by_id=False``) rather meets a dimension of measured small
size line by line: its own aggregation then leaves one row per day, category and task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.functions import money
from tallyroll.operators.enrich import USER_FIELDS, dedupe, product_dim, time_join, time_key, user_dim, with_week
from tallyroll.operators.flatten import LINE_IDENTITY
from tallyroll.operators.joins import BROADCAST_BYTES, lookup_join, measured_bytes
from tallyroll.operators.validity import VALID, valid_join


def repeated_keys(dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows as ``copies``."""
    return dim.groupBy(*on).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def _time(dim: DataFrame, weekly: bool, dedupe_dims: bool = False) -> list[str]:
    """Columns that say when a row holds. Of several rows of an id, one a week is chosen before intervals are made of them."""
    time = time_key(dim, weekly)
    if dedupe_dims and time == VALID:
        raise ValueError("remove repeated ids from the weekly snapshots, not from intervals")
    return list(time)


def _rated_products(products: DataFrame, weekly: bool, dedupe_dims: bool, places: money.Places) -> DataFrame:
    """Products with price in ticks, number of ratings and their sum, converted once per product."""
    rows = product_dim(products, weekly=weekly)
    week = _time(products, weekly, dedupe_dims)
    if dedupe_dims:
        rows = dedupe(rows, [*week, "product_ID"])
    return rows.select(*week, "product_ID", "category", *_rated(F.col("price"), F.col("rate"), F.col("count"), places))


def _named(columns: list[Column], name: str, places: int) -> list[Column]:
    return [column.alias(n) for column, n in zip(columns, money.limb_names(name, places), strict=True)]


def _rated(price: Column, rate: Column, votes: Column, places: money.Places) -> list[Column]:
    return [
        *_named(money.limbs(price, places.price), "price_ticks", places.price),
        *_named([limb * votes for limb in money.limbs(rate, places.rate)], "points", places.rate),
        votes.alias("votes"),
    ]


def _products_of(factor: str, by: Column, name: str, places: int) -> list[Column]:
    """The amount ``factor`` times ``by``, limb by limb, each a pair of bigints."""
    pairs = zip(money.limb_names(factor, places), money.limb_names(name, places), strict=True)
    return [part for limb, out in pairs for part in money.wide_product(F.col(limb), by, out)]


def _product_measures(units: Column, lines: Column, places: money.Places) -> list[Column]:
    """Revenue of ``units`` and rating weights of ``lines`` of one product, as pairs of bigints."""
    return [
        *_products_of("price_ticks", units, "revenue", places.price),
        *_products_of("points", lines, "rating_points", places.rate),
        *money.wide_product(F.col("votes"), lines, "rating_votes"),
    ]


def _price_totals(places: money.Places) -> list[Column]:
    pairs = zip(money.limb_names("price_ticks", places.price), money.limb_names("price_total", places.price), strict=True)
    return [part for limb, out in pairs for part in money.wide_parts(F.col(limb), out)]


def _fits(dim: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, **_) -> bool:
    return measured_bytes(dim) <= broadcast_bytes


def _attributes(summed: DataFrame, rows: DataFrame, key: str, weekly: bool, by: Sequence[str], **join_options) -> DataFrame:
    """Sums per ``by`` and key with the attributes of the key."""
    time = time_key(rows, weekly)
    if time == VALID:
        # A row for each day at most, so no key is hot; to look for one would be to make the sums once more for each look.
        return valid_join(summed, rows, key, by, **{**join_options, "hot_factor": None})
    return (with_week(summed) if weekly else summed).join(rows, [*time, key], "left")


def product_sales(
    lines: DataFrame,
    products: DataFrame,
    users: DataFrame | None = None,
    by: Sequence[str] = (),
    weekly: bool = False,
    dedupe_dims: bool = False,
    by_id: bool = True,
    places: money.Places = money.Places(),
    **join_options,
) -> DataFrame:
    """Measures per ``by`` and product, with the category.

    ``users`` matters only if ids repeat in it: a line then counts once per matching user row.
    Leave it out when the ids are known to be unique. Without ``by_id`` a product may have any
    number of rows.
    """
    copies = F.lit(1).cast("bigint")
    if users is not None and not dedupe_dims:
        week = list(time_key(users, weekly))
        if VALID == tuple(week):
            raise ValueError("whether ids repeat is found in weekly snapshots, not in intervals")
        repeated = repeated_keys(user_dim(users, fields=(), weekly=weekly), [*week, "User_ID"])
        if not repeated.isEmpty():
            lines = with_week(lines) if weekly else lines
            lines = lookup_join(lines, repeated, [*week, "User_ID"], LINE_IDENTITY, **join_options)
            copies = F.coalesce(F.col("copies"), copies)
    rows = _rated_products(products, weekly, dedupe_dims, places)
    weighed = lines.select(
        *by,
        "product_ID",
        (F.col("quantity") * copies).alias("units"),
        F.when(F.col("product_ID").isNotNull(), copies).otherwise(F.lit(0)).alias("lines"),
    )
    if time_key(products, weekly) != VALID and not by_id and _fits(rows, **join_options):
        rows = F.broadcast(rows)
    else:
        weighed = weighed.groupBy(*by, "product_ID").agg(F.sum("units").alias("units"), F.sum("lines").alias("lines"))
    return _attributes(weighed, rows, "product_ID", weekly, by, **join_options).select(
        *by, "product_ID", "category", "units", "lines", *_product_measures(F.col("units"), F.col("lines"), places)
    )


def buyer_sales(
    lines: DataFrame,
    products: DataFrame,
    users: DataFrame,
    by: Sequence[str] = (),
    weekly: bool = False,
    dedupe_dims: bool = False,
    by_id: bool = True,
    places: money.Places = money.Places(),
    keep: Callable[[DataFrame, str], DataFrame] | None = None,
    **join_options,
) -> DataFrame:
    """Measures per ``by`` and buyer, with city, email and names.

    Without ``by_id`` a buyer may have any number of rows and only the city comes along. ``keep`` writes the sums per buyer id down
    before the names are joined, so that the shuffles of both don't lie on disk at once.
    """
    fields = USER_FIELDS if by_id else ("city",)
    if dedupe_dims:
        week = _time(products, weekly, dedupe_dims)
        # By all fields, so that the row kept is the same everywhere.
        prices = _rated_products(products, weekly, dedupe_dims, places).select(*week, "product_ID", *money.limb_names("price_ticks", places.price))
        week = _time(users, weekly, dedupe_dims)
        user_rows = dedupe(user_dim(users, weekly=weekly), [*week, "User_ID"]).select(*week, "User_ID", *fields)
    else:
        price = _named(money.limbs(F.col("price"), places.price), "price_ticks", places.price)
        prices = product_dim(products, fields=("price",), weekly=weekly).select(*time_key(products, weekly), "product_ID", *price)
        user_rows = user_dim(users, fields, weekly)
    valued = time_join(lines, prices, "product_ID", weekly, **join_options)
    priced = F.col("price_ticks").isNotNull().cast("bigint")
    if isinstance(places.price, money.Scale):
        revenue = _products_of("price_ticks", F.col("quantity"), "revenue", places.price)
    else:
        # A price in ticks times one line's quantity is a bigint.
        revenue = money.wide_parts(F.col("price_ticks") * F.col("quantity"), "revenue")
    valued = valued.select(
        *by,
        "User_ID",
        F.col("quantity").alias("units"),
        *revenue,
        *_price_totals(places),
        priced.alias("priced_lines"),
    )
    measures = [name for name in valued.columns if name not in (*by, "User_ID")]
    if time_key(users, weekly) != VALID and not by_id and _fits(user_rows, **join_options):
        user_rows = F.broadcast(user_rows)
    else:
        valued = valued.groupBy(*by, "User_ID").agg(*[F.sum(name).alias(name) for name in measures])
        valued = keep(valued, "buyer_sums") if keep else valued
    return _attributes(valued, user_rows, "User_ID", weekly, by, **join_options).select(*by, "User_ID", *fields, *measures)


def line_measures(enriched: DataFrame, places: money.Places = money.Places()) -> DataFrame:
    """The measures of each single line of the enriched fact."""
    one = F.lit(1).cast("bigint")
    rated = enriched.select("*", *_rated(F.col("price"), F.col("rate"), F.col("count"), places))
    return rated.select(
        *enriched.columns,
        F.col("quantity").alias("units"),
        F.col("product_ID").isNotNull().cast("bigint").alias("lines"),
        *_product_measures(F.col("quantity"), one, places),
        *_price_totals(places),
        F.col("price_ticks").isNotNull().cast("bigint").alias("priced_lines"),
    )
