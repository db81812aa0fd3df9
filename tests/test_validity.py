"""Joins with intervals of weeks against joins with every week."""

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tallyroll.functions import calendar
from tallyroll.operators import validity
from tallyroll.operators.enrich import enrich
from tallyroll.operators.rollups import buyer_sales, product_sales

START = date(2019, 12, 9)
WEEKS = [(START + timedelta(weeks=n)).isocalendar()[:2] for n in range(60)]


@pytest.fixture(scope="module")
def frames(spark):
    """Products that change at times, vanish and come back, repeat or lack an id; users that hardly change; a week without a snapshot."""
    rng, products, users, lines = random.Random(3), [], [], []
    for p in range(12):
        price = 1.0
        for y, w in WEEKS:
            price += rng.random() < 0.1
            for _ in range(0 if rng.random() < 0.1 or (y, w) == WEEKS[20] else 2 if p == 3 and rng.random() < 0.5 else 1):
                products.append((y, w, p if p != 11 else None, f"c{p % 3}", price, p, None if p == 5 else 2.5))
    for u in range(6):
        users += [(y, w, u, f"city{u}" if (y, w) < WEEKS[33] else f"town{u % 2}", "e", "f", "l") for y, w in WEEKS if (y, w) != WEEKS[20]]
    for n in range(1500):
        day = START + timedelta(days=rng.randrange(430))
        lines.append((day, rng.choice([0, 1, 2, 3, 4, 5, 9, None]), rng.choice([*range(12), 3, 3, 3, None]), rng.randint(1, 4), n))
    return (
        spark.createDataFrame(lines, "run_date date, User_ID long, product_ID long, quantity long, cart_id long"),
        spark.createDataFrame(products, "iso_year int, iso_week int, Product_ID long, category string, price double, count long, rate double"),
        spark.createDataFrame(users, "iso_year int, iso_week int, User_ID long, city string, email string, firstname string, lastname string"),
    )


def rows(df):
    return Counter(map(tuple, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": -1}, {"broadcast_bytes": -1, "hot_factor": 0.2}])
def test_enrichment_is_the_same(spark, frames, options):
    lines, products, users = frames
    want = enrich(lines, products, users, by=("run_date",), weekly=True)
    got = enrich(lines, validity.intervals(products, "Product_ID"), validity.intervals(users, "User_ID"), by=("run_date",), weekly=True, **options)
    assert rows(got) == rows(want)


def test_rollups_are_the_same(spark, frames):
    lines, products, users = frames
    valid = [validity.intervals(products, "Product_ID"), validity.intervals(users, "User_ID")]
    options = {"by": ("run_date",), "weekly": True}
    assert rows(product_sales(lines, valid[0], **options)) == rows(product_sales(lines, products, **options))
    assert rows(buyer_sales(lines, *valid, **options)) == rows(buyer_sales(lines, products, users, **options))
    # One of the two as intervals.
    assert rows(buyer_sales(lines, products, valid[1], **options)) == rows(buyer_sales(lines, products, users, **options))
    with pytest.raises(ValueError, match="weekly snapshots"):
        product_sales(lines, *valid, **options)
    with pytest.raises(ValueError, match="weekly snapshots"):
        product_sales(lines, valid[0], dedupe_dims=True, **options)


def test_rows_grow_with_changes_not_with_weeks(spark, frames):
    _, _, users = frames
    found = validity.intervals(users, "User_ID")
    # Before and after the missing week, and after the move.
    assert found.count() == 6 * 3 and users.count() == 6 * 59
    assert validity.packed(found, "User_ID").count() <= 6 * (60 // validity.EPOCH + 2)
    assert validity.intervals(users.limit(0), "User_ID").count() == 0


def test_week_numbers(spark):
    days = spark.createDataFrame([(date(1969, 12, 1) + timedelta(days=n * 5),) for n in range(5000)], "d date")
    d = F.col("d")
    for r in days.select("d", validity.week_of(d).alias("of"), validity.week_number(calendar.iso_year(d), calendar.iso_week(d)).alias("n")).collect():
        assert r.of == r.n == (r.d - date(1970, 1, 5)).days // 7
