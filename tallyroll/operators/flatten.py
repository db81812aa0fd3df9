"""Nested documents to flat rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


LINE_IDENTITY = ("cart_id", "product_ID", "quantity")

# Names and order of the flat columns below.


def flatten_users(users: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Flat users; ``keep`` names partition columns to carry along."""
    return users.select(
        *keep,
        F.col("__v").alias("__V"),
        F.col("address.city").alias("city"),
        F.col("address.geolocation.lat").alias("lat"),
        F.col("address.geolocation.long").alias("long"),
        F.col("address.number").alias("number"),
        F.col("address.street").alias("street"),
        F.col("address.zipcode").alias("zipcode"),
        "email",
        F.col("id").alias("User_ID"),
        F.col("name.firstname").alias("firstname"),
        F.col("name.lastname").alias("lastname"),
        "password",
        "phone",
        "username",
    )


def flatten_products(products: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Flat products; ``keep`` names partition columns to carry along."""
    return products.select(
        *keep,
        "category",
        "description",
        F.col("id").alias("Product_ID"),
        "image",
        "price",
        F.col("rating.count").alias("count"),
        F.col("rating.rate").alias("rate"),
        "title",
    )


def cart_lines(carts: DataFrame, buyer_col: str = "id") -> DataFrame:
    """One row per product in a cart; carts without products vanish.

    ``buyer_col`` becomes ``User_ID``: the cart's own id gives the literal behaviour, its
    ``userId`` the buyer behind the cart.
    """
    return carts.withColumn("product", F.explode("products")).select(
        F.col("__v").alias("__V"),
        "date",
        F.col(buyer_col).alias("User_ID"),
        F.col("product.productId").alias("product_ID"),
        F.col("product.quantity").alias("quantity"),
    )


def sale_lines(carts: DataFrame, buyer_col: str = "id", by: Sequence[str] = ()) -> DataFrame:
    """Cart lines with what the rollups need, plus the cart id.

    A plain explode lets the scan read only the fields in use. Cart, product and quantity
    together tell the lines of one hot product, buyer or cart apart (``LINE_IDENTITY``).
    """
    return carts.withColumn("product", F.explode("products")).select(
        *by,
        F.col(buyer_col).alias("User_ID"),
        F.col("product.productId").alias("product_ID"),
        F.col("product.quantity").alias("quantity"),
        F.col("id").alias("cart_id"),
    )
