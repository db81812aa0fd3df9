"""Joins of large dimensions, numbering, arithmetic, calendar, readers, landing."""

import os
import random
from collections import Counter
from datetime import date, timedelta
from decimal import Decimal
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyroll.functions import calendar, money
from tallyroll.operators import joins, numbering
from tallyroll.operators.enrich import enrich
from tallyroll.operators.rollups import buyer_sales, line_measures, product_sales
from tallyroll.plans.metrics import METRICS
from tallyroll.session import object_store_settings, scratch_path, settled
from tallyroll.sources import landing, raw, zones


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the lines on product 7, a third without a product, a third spread out."""
    n = F.col("id")
    product = F.when(n % 3 == 0, F.lit(7)).when(n % 3 == 1, F.lit(None)).otherwise(n % 1000)
    return (
        spark.range(0, 60_000, 1, 8)
        .select(
            F.lit(date(2025, 4, 14)).alias("run_date"),
            F.when(n % 5 == 0, F.lit(3)).otherwise(n % 400).alias("User_ID"),
            product.cast("bigint").alias("product_ID"),
            (n % 9 + 1).alias("quantity"),
            n.alias("cart_id"),
        )
    )


@pytest.fixture(scope="module")
def dims(spark):
    n = F.col("id")
    products = spark.range(0, 900).select(
        n.alias("Product_ID"),
        F.concat(F.lit("c"), (n % 5).cast("string")).alias("category"),
        (n / 8 + 1).alias("price"),
        (n % 50).alias("count"),
        (n % 50 / 10).alias("rate"),
    )
    users = spark.range(0, 300).select(
        n.alias("User_ID"),
        (n % 7).cast("string").alias("city"),
        n.cast("string").alias("email"),
        n.cast("string").alias("firstname"),
        n.cast("string").alias("lastname"),
    )
    repeated = products.where("Product_ID in (7, 8)").withColumn("price", F.lit(2.5))
    return products.unionByName(repeated), users.unionByName(users.where("User_ID = 3"))


def test_hot_keys_are_those_beyond_a_mean_partition(skewed):
    found = {r.product_ID: r._parts for r in joins.hot_keys(skewed, ["product_ID"], 8).collect()}
    assert found == {7: 11, None: 11}
    # The more partitions, the smaller a hot key: User_ID 3 has a fifth of the rows.
    found = {r.User_ID: r._parts for r in joins.hot_keys(skewed, ["User_ID"], 100).collect()}
    assert set(found) == {3} and 80 <= found[3] <= 82
    both = {(r.User_ID, r.product_ID) for r in joins.hot_keys(skewed, ["User_ID", "product_ID"], 100).collect()}
    assert both == {(3, 7), (3, None)}


def test_no_hot_keys_in_even_data(spark):
    even = spark.range(100_000).select((F.col("id") % 1000).alias("k"))
    assert joins.hot_keys(even, ["k"], 200) is None
    assert joins.hot_keys(even.limit(0), ["k"], 200) is None


def test_measured_bytes(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None), (3, "é")], "k long, t string")
    assert joins.measured_bytes(df) == 3 * 32 + 3 + 2
    assert joins.measured_bytes(df.limit(0)) == 0


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(skewed, dims, how):
    dim = dims[0].withColumnRenamed("Product_ID", "product_ID")
    plain = skewed.join(dim, "product_ID", how)
    salted = joins.lookup_join(skewed, dim, ["product_ID"], ["cart_id"], broadcast_bytes=0, how=how)
    assert salted.columns == plain.columns
    counts = [Counter(map(tuple, df.collect())) for df in (plain, salted)]
    assert counts[0] == counts[1]
    assert "_salt" in salted._jdf.queryExecution().toString()


def test_salt_spreads_the_hot_key(spark, skewed, dims):
    """No task gets much more than its share of the rows of a hot product."""
    dim = dims[0].withColumnRenamed("Product_ID", "product_ID")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salted = joins.lookup_join(skewed, dim, ["product_ID"], ["cart_id"], broadcast_bytes=0)
        per_task = [r["count"] for r in salted.groupBy(F.spark_partition_id()).count().collect()]
        plain = skewed.join(dim, "product_ID", "left")
        worst = max(r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(per_task) == salted.count()
    assert max(per_task) < worst / 2


def test_broadcast_only_below_the_measured_limit(skewed, dims):
    dim = dims[0].withColumnRenamed("Product_ID", "product_ID")
    size = joins.measured_bytes(dim)

    def plan(limit):
        return joins.lookup_join(skewed, dim, ["product_ID"], ["cart_id"], broadcast_bytes=limit, hot_factor=100)._jdf.queryExecution().toString()

    assert "strategy=broadcast" in plan(size)
    assert "strategy=broadcast" not in plan(size - 1)


@pytest.mark.parametrize("name", METRICS)
def test_rollups_equal_single_lines_on_skewed_data(skewed, dims, name):
    metric = METRICS[name]
    rollup = product_sales if metric.source == "product" else buyer_sales
    by = ("run_date",)
    expected = metric.compute(line_measures(enrich(skewed, *dims, by=by)), by=by).collect()
    assert metric.compute(rollup(skewed, *dims, by=by, broadcast_bytes=0), by=by).collect() == expected
    assert metric.compute(rollup(skewed, *dims, by=by), by=by).collect() == expected
    if not metric.by_id:
        for limit in (0, joins.BROADCAST_BYTES):
            options = {"by": by, "by_id": False, "broadcast_bytes": limit}
            assert metric.compute(rollup(skewed, *dims, **options), by=by).collect() == expected
    assert metric.compute(line_measures(enrich(skewed, *dims, by=by, broadcast_bytes=0)), by=by).collect() == expected


def test_totals_agree(skewed, dims):
    """Sums over categories, buyers and cities give the same total."""
    per_product, per_buyer = product_sales(skewed, *dims), buyer_sales(skewed, *dims)
    total = METRICS["total_day_revenue"].compute(per_product).first()[0]
    for name, sales in [("revenue_by_category", per_product), ("rev_prod_cat", per_product), ("revenue_by_users_ID", per_buyer), ("total_revenue_per_city", per_buyer)]:
        metric = METRICS[name]
        values = [r[metric.output] or 0 for r in metric.compute(sales).collect()]
        # Half a cent of rounding in the total, and in each row of the metric that rounds.
        rounded = 1 + (len(values) if name == "total_revenue_per_city" else 0)
        assert sum(values) == pytest.approx(total, abs=0.005 * rounded + 1e-6)
    units = [METRICS[n].compute(s).agg(F.sum(METRICS[n].output)).first()[0] for n, s in [("total_quantity_per_prod", per_product), ("ord_bycity", per_buyer)]]
    assert units[0] == units[1]


def test_numbering_of_a_group_over_many_partitions(spark):
    n = F.col("id")
    df = spark.range(0, 20_000, 1, 8).select(
        F.when(n % 3 == 0, F.lit(date(2025, 4, 14))).when(n % 3 == 1, F.lit(None)).otherwise(F.expr("date_add(DATE'2025-05-01', int(id % 30))")).alias("run_date"),
        n.alias("k"),
        F.when(n % 2 == 0, F.lit(1)).otherwise(n % 5).alias("v"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = numbering.number_rows(df, ["run_date"], [F.col("v").desc(), F.col("k").asc()])
        rows = numbered.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert numbered.columns == ["run_date", "k", "v", "row_no"]
    groups = {}
    for r in rows:
        groups.setdefault(r.run_date, []).append(r)
    # The spread third has the ids 2, 5, 8, …: ten different remainders by 30.
    assert len(rows) == 20_000 and len(groups) == 2 + 10
    for group in groups.values():
        ordered = sorted(group, key=lambda r: (-r.v, r.k))
        assert [r.row_no for r in ordered] == list(range(1, len(group) + 1))


def test_numbering_without_groups(spark):
    numbered = numbering.number_rows(spark.range(1000), [], [F.col("id").desc()])
    assert all(r.row_no == 1000 - r.id for r in numbered.collect())


amounts = st.integers(-(10**15), 10**15)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(amounts, st.integers(0, 10**6)), min_size=1, max_size=30))
def test_money(spark, values):
    df = spark.createDataFrame(values, "t long, n long")
    t, n = F.col("t"), F.col("n")
    parts = df.select(*money.wide_parts(t, "s"), *money.wide_product(t % (1 << 46), n, "p"))
    total = parts.agg(money.wide_total("s").alias("s"), money.wide_total("p").alias("p")).first()
    assert total.s == sum(v for v, _ in values)
    assert total.p == sum((abs(v) % (1 << 46)) * (-1 if v < 0 else 1) * m for v, m in values)
    out = df.select(
        "t", "n", money.ratio_half_up(t, n, 2).alias("r2"), money.ratio_half_up(t, n, 1).alias("r1"), money.amount(t).alias("a")
    )
    for r in out.collect():
        assert r.a == Decimal(r.t).scaleb(-4)
        for got, places in [(r.r2, 2), (r.r1, 1)]:
            if r.n == 0:
                assert got is None
            else:
                # Exact: scaled to an integer ratio, then half away from zero.
                num, den = abs(r.t) * 10**places, r.n * 10**4
                whole = (2 * num + den) // (2 * den)
                assert got == (-1 if r.t < 0 else 1) * whole / 10**places


def test_money_beyond_bigint(spark):
    big = 9 * 10**18
    df = spark.createDataFrame([(big,), (big,), (-5,), (None,)], "t long")
    parts = df.select("t", *money.wide_parts(F.col("t"), "s"))
    assert parts.agg(money.wide_total("s")).first()[0] == 2 * big - 5
    assert parts.where("t is null").agg(money.wide_total("s")).first()[0] is None
    # More than a bigint holds: a price of 10**8 ticks times 10**15 units.
    df = spark.createDataFrame([(10**8, 10**15), (10**13, 3)], "p long, u long")
    parts = df.select(*money.wide_product(F.col("p"), F.col("u"), "r"))
    assert parts.agg(money.wide_total("r")).first()[0] == 10**23 + 3 * 10**13


def test_ticks(spark):
    df = spark.createDataFrame([(109.95,), (0.1 + 0.2,), (22.3,), (None,)], "p double")
    assert [r[0] for r in df.select(money.to_ticks(F.col("p"))).collect()] == [1099500, 3000, 223000, None]
    fine = spark.createDataFrame([(0.00004, 4.5), (1.0, None)], "price double, rate double")
    with pytest.raises(Exception, match="4.0E-5 has more than 4 decimal places"):
        fine.select(money.to_ticks(F.col("price"))).collect()
    assert money.places_needed(fine) == (5, 4)
    assert money.places_needed(fine.limit(0)) == (4, 4)
    assert fine.select(money.to_ticks(F.col("price"), 5)).first()[0] == 4
    # Finer ones are cut into limbs, as many as the digits from the finest to the largest value take.
    for value, places, limbs in ((1e-12, 12, 1), (1e15, 4, 2), (1 / 3, 16, 2), (-2.5e-300, 301, 1), (1.5e300, 4, 34)):
        found = money.places_needed(spark.createDataFrame([(value, 1.0), (None, None)], "price double, rate double"))
        assert (found.price, found.price.limbs, found.rate) == (places, limbs, 4), value
    for value in (float("nan"), float("inf"), -float("inf")):
        with pytest.raises(money.NotFinite, match="rate"):
            money.places_needed(spark.createDataFrame([(1.0, value)], "price double, rate double"))


# Products with prices and rates of all sizes; the value of a double is its shortest decimal.
WILD = {
    "as ticks": [0.1, 0.2, 19.99, 7.0],
    "thirds": [1 / 3, 1e-12, 1e15, 0.1],
    "negative": [-1 / 3, 1 / 3, -1e15, 1e-12, -7.25],
    "cancelling": [1e22, -1e22, 1e-9, 1 / 7],
    "far apart": [1e40, -1e40, 3e-40, 2.5],
    "large": [123456789012345678.0, 1e16, 9007199254740993.0, 0.5],
    "halves": [0.005, 0.015, 1.005, 2.675, 1e-13],
}


@pytest.mark.parametrize("name", WILD)
def test_sums_of_any_doubles_are_exact(spark, name):
    prices = WILD[name]
    exact = [Fraction(Decimal(repr(p))) for p in prices]
    rng = random.Random(1)
    rows = [(i % 5, i % len(prices), rng.choice([1, 6, 70_000]), i) for i in range(60)]
    lines = spark.createDataFrame(rows, "User_ID long, product_ID long, quantity long, cart_id long").repartition(7)
    products = spark.createDataFrame([(i, f"c{i % 2}", p, i + 1, abs(p) if abs(p) < 1e9 else 1 / 3) for i, p in enumerate(prices)], "Product_ID long, category string, price double, count long, rate double")
    users = spark.createDataFrame([(u, f"city{u % 2}", "e", "f", "l") for u in range(5)], "User_ID long, city string, email string, firstname string, lastname string")
    places = money.places_needed(products)
    sums = {"product": product_sales(lines, products, places=places), "buyer": buyer_sales(lines, products, users, places=places), "lines": line_measures(enrich(lines, products, users), places)}

    def result(metric, source):
        return {tuple(r)[:-1]: r[-1] for r in METRICS[metric].compute(sums[source], places=places).collect()}

    def nearest(values):
        return float(sum(values, Fraction(0)))

    def rounded(value, digits):
        whole = (abs(value) * 10**digits * 2 + 1) // 2
        return (-1 if value < 0 else 1) * float(whole) / 10**digits

    by_category = {(c,): [exact[p] * q for _, p, q, _ in rows if f"c{p % 2}" == c] for c in ("c0", "c1")}
    by_user = {u: [(p, q) for w, p, q, _ in rows if w == u] for u in range(5)}
    for source in ("product", "lines"):
        assert result("revenue_by_category", source) == {k: nearest(v) for k, v in by_category.items()}
        # A total without a digit left to round is given as it is.
        whole = sum((x for v in by_category.values() for x in v), Fraction(0))
        assert result("total_day_revenue", source)[()] == (rounded(whole, 2) if abs(whole) < 10**15 else pytest.approx(float(whole), rel=1e-15))
    for source in ("buyer", "lines"):
        got = result("revenue_by_users_ID", source)
        assert {k[0]: v for k, v in got.items()} == {u: nearest([exact[p] * q for p, q in of]) for u, of in by_user.items()}
        means = {k[0]: v for k, v in result("avg_ordval_per_user", source).items()}
        for u, of in by_user.items():
            mean = sum((exact[p] for p, _ in of), Fraction(0)) / len(of)
            assert means[u] == (rounded(mean, 2) if abs(mean) < 10**13 else pytest.approx(float(mean), rel=1e-15)), (u, mean)
    rates = [Fraction(Decimal(repr(abs(p) if abs(p) < 1e9 else 1 / 3))) for p in prices]
    ratings = result("avg_rat_per_cat", "product")
    for c in ("c0", "c1"):
        of = [p for _, p, _, _ in rows if f"c{p % 2}" == c]
        assert ratings[(c,)] == rounded(sum((rates[p] * (p + 1) for p in of), Fraction(0)) / sum(p + 1 for p in of), 1)


def test_sums_of_any_doubles_do_not_depend_on_the_order(spark):
    rng = random.Random(4)
    prices = [rng.uniform(-1, 1) * 10.0 ** rng.randint(-30, 30) for _ in range(200)]
    products = spark.createDataFrame([(i, "c", p, 1, 1.0) for i, p in enumerate(prices)], "Product_ID long, category string, price double, count long, rate double")
    places = money.places_needed(products)
    want = float(sum((Fraction(Decimal(repr(p))) * (i % 9 + 1) for i, p in enumerate(prices)), Fraction(0)))
    for parts in (1, 3, 8):
        lines = spark.createDataFrame([(1, i, i % 9 + 1, i) for i in rng.sample(range(200), 200)], "User_ID long, product_ID long, quantity long, cart_id long").repartition(parts)
        assert METRICS["revenue_by_category"].compute(product_sales(lines, products, places=places), places=places).first()[1] == want


def test_fine_prices_keep_their_revenue(spark):
    lines = spark.createDataFrame([(1, 1, 100_000, 1)], "User_ID long, product_ID long, quantity long, cart_id long")
    products = spark.createDataFrame([(1, "c", 0.00004, 1, 4.5)], "Product_ID long, category string, price double, count long, rate double")
    places = money.places_needed(products)
    metric = METRICS["revenue_by_category"]
    assert metric.compute(product_sales(lines, products, places=places), places=places).first()[1] == 4.0


def test_calendar_matches_python(spark):
    days = [date(2019, 12, 25) + timedelta(days=n) for n in range(2200)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    d = F.col("d")
    for r in df.select(
        "d", calendar.iso_year(d).alias("y"), calendar.iso_week(d).alias("w"), calendar.week_label(d).alias("label"),
        calendar.refresh_due(d).alias("due"), calendar.refresh_due(d, force=True).alias("forced"), calendar.day_label(d).alias("text"),
    ).collect():
        year, week, _ = r.d.isocalendar()
        assert (r.y, r.w, r.label, r.text) == (year, week, f"week_{year}_{week}", r.d.isoformat())
        assert r.due == calendar.is_refresh_day(r.d) and r.forced
    assert date(2024, 12, 30).isocalendar()[:2] == (2025, 1)


def test_weekly_landing_gate_and_replacement(spark, tmp_path):
    base = str(tmp_path)
    monday, tuesday = date(2024, 12, 30), date(2024, 12, 31)
    df = spark.range(3)
    assert not landing.land_weekly(df, base, "products", tuesday)
    assert landing.land_weekly(df, base, "products", monday)
    assert landing.land_weekly(df.limit(1), base, "products", tuesday, force=True)
    table = zones.read_table(spark, zones.zone(base, "raw", "products"))
    assert [(r.iso_year, r.iso_week) for r in table.collect()] == [(2025, 1)]


def test_daily_landing_stamps_and_replaces_one_day(spark, tmp_path):
    base = str(tmp_path)
    carts = spark.createDataFrame([(1, "2020-01-01"), (2, "2020-01-02")], "id long, date string")
    landing.land_carts(carts, base, date(2025, 4, 14))
    landing.land_carts(carts, base, date(2025, 4, 15))
    landing.land_carts(carts.where("id = 2"), base, date(2025, 4, 15))
    assert sorted((r.id, r.date, str(r.run_date)) for r in landing.read_carts(spark, base).collect()) == [
        (1, "2025-04-14", "2025-04-14"), (2, "2025-04-14", "2025-04-14"), (2, "2025-04-15", "2025-04-15"),
    ]
    landing.land_carts(carts.limit(0), base, date(2025, 4, 15))
    assert landing.read_carts(spark, base).count() == 2
    assert landing.landed_days(spark, base) == [date(2025, 4, 14), date(2025, 4, 15)]
    assert landing.read_carts(spark, base, date(2025, 4, 15), date(2025, 4, 15)).count() == 0


def test_history_landing_touches_only_its_days(spark, tmp_path):
    base = str(tmp_path)
    one = spark.createDataFrame([(1, "2025-04-14T08:00:00.000Z"), (2, "2025-04-15")], "id long, date string")
    landing.land_carts_history(one, base)
    landing.land_carts_history(one.where("id = 2").withColumn("id", F.lit(9).cast("bigint")), base)
    table = landing.read_carts(spark, base)
    assert sorted((r.id, r.date) for r in table.collect()) == [
        (1, "2025-04-14T08:00:00.000Z"), (9, "2025-04-15"),
    ]
    # The folder of the second landing, which has no cart of this day, is not listed.
    one_day = landing.read_carts(spark, base, date(2025, 4, 14), date(2025, 4, 14))
    assert one_day.count() == 1 and len({f.split("run=")[1][:32] for f in one_day.inputFiles()}) == 1
    assert len({f.split("run=")[1][:32] for f in table.inputFiles()}) == 2


def test_missing_raw_input(spark, tmp_path):
    nowhere = str(tmp_path / "nowhere.json")
    with pytest.raises(raw.MissingInput, match="users"):
        raw.read_raw(spark, "users", nowhere)
    nothing = raw.read_raw(spark, "carts", nowhere, missing="empty")
    assert nothing.count() == 0 and "products" in nothing.columns


def test_json_lines_need_no_multi_line(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.range(25).selectExpr("id", "cast(id as double) as price").coalesce(1).write.json(path)
    assert raw.read_raw(spark, "products", path, multi_line=False).count() == 25


def test_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,price,name\n1,2.5,a\n2,3,b\n")
    assert raw.read_csv(spark, str(path)).dtypes == [("id", "int"), ("price", "double"), ("name", "string")]
    given = raw.read_csv(spark, str(path), spark.createDataFrame([], "id long, price double, name string").schema)
    assert [tuple(r) for r in given.collect()] == [(1, 2.5, "a"), (2, 3.0, "b")]


def test_table_name(spark):
    df = spark.createDataFrame([("s3a://b/partition_2025-04-14/ord_bycity.parquet",)], "p string")
    assert df.select(zones.table_name(F.col("p"))).first()[0] == "ord_bycity"
    df = spark.createDataFrame([("s3a://b/analytics/rev_prod_cat/run_date=2025-04-14/part-00000-x.snappy.parquet",), ("/t/x/year=1/week=2/part-0.parquet",), ("/t/orders.parquet/part-0001.parquet",)], "p string")
    assert [r[0] for r in df.select(zones.table_name(F.col("p"))).collect()] == ["rev_prod_cat", "x", "orders"]


def test_only_the_wanted_partitions_are_listed(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.range(20).selectExpr("id", "date_add(DATE'2025-04-01', int(id)) AS run_date")
    zones.replace_partitions(days, path, by=["run_date"])
    one = zones.read_table(spark, path, only=zones.between("run_date", date(2025, 4, 5), date(2025, 4, 6)))
    assert {f.split("run_date=")[1][:10] for f in one.inputFiles()} == {"2025-04-05", "2025-04-06"}
    assert sorted(map(tuple, one.collect())) == [(4, date(2025, 4, 5)), (5, date(2025, 4, 6))]
    with pytest.raises(raw.MissingInput):
        zones.read_table(spark, path, only=zones.between("run_date", date(2026, 1, 1), date(2026, 1, 2)))


def test_undated_carts_are_stamped_or_refused(spark, tmp_path):
    carts = spark.createDataFrame([(1, "2025-04-14"), (2, None)], "id long, date string")
    with pytest.raises(Exception, match="cart without a date: 2"):
        landing.land_carts_history(carts, str(tmp_path / "a"))
    landing.land_carts_history(carts, str(tmp_path / "b"), undated=date(2025, 4, 15))
    assert not list((tmp_path / "a" / "raw" / "carts").glob("run=*"))
    table = landing.read_carts(spark, str(tmp_path / "b"))
    assert {r.id: r.run_date for r in table.collect()} == {1: date(2025, 4, 14), 2: date(2025, 4, 15)}


def test_absent_table_reads_as_no_rows(spark, tmp_path):
    schema = spark.range(1).schema
    assert zones.read_table(spark, str(tmp_path / "no"), schema=schema, missing="empty").count() == 0
    with pytest.raises(raw.MissingInput):
        zones.read_table(spark, str(tmp_path / "no"))


def test_scratch_follows_the_cluster_setting(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_settled_files_go_with_their_owner(spark):
    with settled(spark) as keep:
        kept = keep(spark.range(5), "x")
        folder = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert kept.count() == 5 and os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_object_store_settings():
    given = object_store_settings("http://store", "k", "s")
    assert given["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert all(key.startswith("spark.hadoop.fs.s3a.") for key in given)
