"""The twelve metrics, as sums over the measures of ``operators.rollups``.

A metric is a grouping, a measure and an order. Given ``by=("run_date",)`` each is computed
for every day at once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroll.functions import money

BUYER_KEYS = ("User_ID", "firstname", "lastname", "email")


def _revenue(places: money.Places) -> Column:
    return money.total("revenue", places.price)


def _revenue_cents(places: money.Places) -> Column:
    return money.total_half_up("revenue", 2, places.price)


def _units(places: money.Places) -> Column:
    return F.sum("units")


def _lines(places: money.Places) -> Column:
    return F.sum("lines")


def _mean_price(places: money.Places) -> Column:
    return money.mean_half_up("price_total", F.sum("priced_lines"), 2, places.price)


def _mean_rating(places: money.Places) -> Column:
    return money.mean_half_up("rating_points", money.wide_total("rating_votes"), 1, places.rate)


@dataclass(frozen=True)
class Metric:
    """``source`` names the rollup: ``product`` or ``buyer``. ``top`` keeps only the first row."""

    name: str
    source: str
    keys: tuple[str, ...]
    measure: Callable[[money.Places], Column]
    output: str
    top: bool = False

    @property
    def by_id(self) -> bool:
        """Whether the rows are per product or buyer id, rather than per attribute."""
        return any(key.lower().endswith("_id") for key in self.keys)

    def order(self) -> list[Column]:
        """Largest value first, NULL last; ties by key, so that the order is total."""
        return [F.col(self.output).desc_nulls_last(), *[F.col(key).asc_nulls_first() for key in self.keys]]

    def compute(self, sales: DataFrame, by: Sequence[str] = (), ordered: bool = True, places: money.Places = money.Places()) -> DataFrame:
        """The metric over measures, for all rows or per ``by``. ``places`` are those the measures were made with.

        ``ordered`` sorts the result; leave it off where the writer sorts anyway.
        """
        result = (
            sales.groupBy(*by, *self.keys)
            .agg(self.measure(places).alias(self.output))
            .select(*by, *[F.col(key).alias(key) for key in self.keys], self.output)
        )
        if self.top and not by:
            return result.orderBy(*self.order()).limit(1)
        if self.top:
            # Spark keeps one row per day and task before the shuffle (WindowGroupLimit).
            place = F.row_number().over(Window.partitionBy(*by).orderBy(*self.order()))
            result = result.withColumn("_place", place).where("_place = 1").drop("_place")
        if not ordered or not (by or self.keys):
            return result
        return result.orderBy(*by, *self.order())


# Names, keys and result columns of the twelve metrics.
METRICS: dict[str, Metric] = {
    metric.name: metric
    for metric in [
        Metric("revenue_by_category", "product", ("category",), _revenue, "total_revenue_byCat"),
        Metric("revenue_by_users_ID", "buyer", BUYER_KEYS, _revenue, "total_revenue_byUser"),
        Metric("total_day_revenue", "product", (), _revenue_cents, "total_day_revenue"),
        Metric("total_quantity_per_prod", "product", ("Product_ID", "category"), _units, "quantity_per_productID"),
        # The mean unit price over the buyer's lines, not the value of an order.
        Metric("avg_ordval_per_user", "buyer", BUYER_KEYS, _mean_price, "avg_ordval_per_UserID"),
        # A product counts once per line sold, weighted by its number of ratings.
        Metric("avg_rat_per_cat", "product", ("category",), _mean_rating, "Weighted_avg_rating_per_category"),
        Metric("total_revenue_per_city", "buyer", ("city",), _revenue_cents, "Total_revenue_city"),
        # Cart lines per product, not distinct products.
        Metric("num_of_prod_sold", "product", ("product_ID",), _lines, "Num_prod_sold"),
        Metric("rev_prod_cat", "product", ("category", "product_ID"), _revenue, "revenue_prod_byCat"),
        Metric("top_user_rev", "buyer", ("user_ID", *BUYER_KEYS[1:]), _revenue, "Top_user_revenue", top=True),
        Metric("top_prod_rev", "product", ("product_ID", "category"), _revenue, "Top_product_revenue", top=True),
        # Units per city, not orders.
        Metric("ord_bycity", "buyer", ("city",), _units, "Orders_by_city"),
    ]
}
