"""The retail model over the TPC-H-like test tables.

    products  part                        rating derived from size and price
    users     customer with its nation
    carts     orders with their lines
    run date  day of o_orderdate
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.functions import calendar
from tallyroll.operators.joins import lookup_join


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _day(column: str) -> Column:
    return F.to_date(column)


def _user_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What user documents are made of."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_name", "c_nationkey", "c_mktsegment")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")


def user_fields() -> dict[str, Column]:
    """The fields of a user document but its id."""
    return {
        "__v": F.lit(0).cast("bigint"),
        "email": F.concat("c_name", F.lit("@example.com")),
        "username": F.col("c_name"),
        "password": F.sha2("c_name", 256),
        "phone": F.concat_ws("-", F.col("c_nationkey").cast("string"), F.col("id").cast("string")),
        "name": F.struct(
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("firstname"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("lastname"),
        ),
        "address": F.struct(
            F.col("n_name").alias("city"),
            F.col("c_mktsegment").alias("street"),
            F.col("id").alias("number"),
            F.col("c_nationkey").cast("string").alias("zipcode"),
            F.struct(
                F.col("n_nationkey").cast("string").alias("lat"), F.col("n_regionkey").cast("string").alias("long")
            ).alias("geolocation"),
        ),
    }


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested user documents."""
    return _documents(_user_rows(spark, sf_dir), user_fields())


def _documents(rows: DataFrame, fields: Mapping[str, Column], keep: Sequence[str] = ()) -> DataFrame:
    return rows.select("id", *keep, *(column.alias(name) for name, column in fields.items()))


def _product_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What product documents are made of."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_name", "p_retailprice", "p_brand", "p_type", "p_size")


def product_fields(weekly: bool = False) -> dict[str, Column]:
    """The fields of a product document but its id; ``weekly`` at a price of the week."""
    price = F.col("p_retailprice")
    return {
        "title": F.col("p_name"),
        "price": F.round(price + F.col("iso_week") / F.lit(100.0), 2) if weekly else price,
        "description": F.col("p_brand"),
        "category": F.col("p_type"),
        "image": F.concat_ws("/", "p_brand", "p_name"),
        "rating": F.struct((F.col("p_size") / F.lit(10.0)).alias("rate"), F.floor("p_retailprice").cast("bigint").alias("count")),
    }


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested product documents."""
    return _documents(_product_rows(spark, sf_dir), product_fields())


def weekly_product_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the documents of ``weekly_products`` are made of, by ``product_fields``: fewer bytes to shuffle."""
    shipped = (
        table(spark, sf_dir, "lineitem")
        .select(
            calendar.iso_year(_day("l_shipdate")).alias("iso_year"),
            calendar.iso_week(_day("l_shipdate")).alias("iso_week"),
            F.col("l_partkey").alias("id"),
        )
        .distinct()
    )
    return shipped.join(_product_rows(spark, sf_dir), "id")


def weekly_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product snapshots per ISO week: the parts shipped in that week, at a price of that week.

    A part can be ordered in a week in which none was shipped; such lines find no product.
    """
    return _documents(weekly_product_rows(spark, sf_dir), product_fields(weekly=True), calendar.WEEK_KEY)


def weekly_user_rows(spark: SparkSession, sf_dir: str, ordered: DataFrame | None = None) -> DataFrame:
    """What the documents of ``weekly_users`` are made of, by ``user_fields``: fewer bytes to shuffle. ``ordered``: as in ``sale_lines``."""
    lines = _ordered_lines(spark, sf_dir) if ordered is None else ordered
    active = lines.select(
        calendar.iso_year(_day("l_shipdate")).alias("iso_year"),
        calendar.iso_week(_day("l_shipdate")).alias("iso_week"),
        F.col("o_custkey").alias("id"),
    ).distinct()
    return active.join(_user_rows(spark, sf_dir), "id")


def weekly_users(spark: SparkSession, sf_dir: str, ordered: DataFrame | None = None) -> DataFrame:
    """User snapshots per ISO week: the customers who were sent something in that week."""
    return _documents(weekly_user_rows(spark, sf_dir, ordered), user_fields(), calendar.WEEK_KEY)


def _ordered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with date and owner of their order."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    spread = ["l_linenumber", "l_partkey", "l_quantity"]
    return lookup_join(table(spark, sf_dir, "lineitem"), orders, ["l_orderkey"], spread, how="inner")


def ordered_lines(spark: SparkSession, sf_dir: str, *also: str) -> DataFrame:
    """What ``sale_lines`` takes of the lines and their orders, and some columns more: a query that needs them more than once writes them down."""
    return _ordered_lines(spark, sf_dir).select("l_orderkey", "o_orderdate", "l_partkey", "l_quantity", *also)


def sale_lines(
    spark: SparkSession, sf_dir: str, owner: bool = False, dated: bool = False, where: str | None = None, monthly: bool = False, ordered: DataFrame | None = None
) -> DataFrame:
    """Lines in the form of ``operators.flatten.sale_lines``, straight from the flat tables.

    The order is the cart. Only its owner and its date (``dated``, or the first of its month) need the orders table, or its
    lines as they were written down, ``ordered``.
    """
    day = F.trunc(_day("o_orderdate"), "month") if monthly else _day("o_orderdate")
    lines = (_ordered_lines(spark, sf_dir) if ordered is None else ordered) if owner or dated else table(spark, sf_dir, "lineitem")
    if where:
        lines = lines.where(where)
    return lines.select(
        *([day.alias("run_date")] if dated else []),
        F.col("o_custkey" if owner else "l_orderkey").alias("User_ID"),
        F.col("l_partkey").alias("product_ID"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_orderkey").alias("cart_id"),
    )


def carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested cart documents: one for each order with all its lines, also for orders without any."""
    product = F.struct(F.col("l_partkey").alias("productId"), F.col("l_quantity").cast("bigint").alias("quantity"))
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(product)).alias("products"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("id"),
        F.lit(0).cast("bigint").alias("__v"),
        F.col("o_custkey").alias("userId"),
        calendar.day_label(_day("o_orderdate")).alias("date"),
        F.coalesce("products", F.array().cast(lines.schema["products"].dataType)).alias("products"),
    )
