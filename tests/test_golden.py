"""The hand-checked data set through every route to the metrics."""

from datetime import date

import pytest
from pyspark.sql import functions as F

import golden
from tallyroll.operators.enrich import MissingSnapshot, enrich
from tallyroll.operators.flatten import cart_lines, flatten_products, flatten_users, sale_lines
from tallyroll.operators.rollups import buyer_sales, line_measures, product_sales
from tallyroll.plans import publish, runs, warehouse
from tallyroll.plans.metrics import METRICS
from tallyroll.plans.runs import run_day, run_history
from tallyroll.sources import landing, raw, zones

DAY = date(2025, 4, 14)  # a Monday
NEXT = date(2025, 4, 15)


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    paths = golden.write_raw(tmp_path_factory.mktemp("raw"))
    return {kind: raw.read_raw(spark, kind, path) for kind, path in paths.items()}


@pytest.fixture(scope="module")
def flat(documents):
    return sale_lines(documents["carts"]), flatten_products(documents["products"]), flatten_users(documents["users"])


def rows(df):
    return [tuple(row) for row in df.collect()]


def test_explode_keeps_every_line_and_drops_the_empty_cart(documents):
    lines = cart_lines(documents["carts"])
    assert lines.columns == ["__V", "date", "User_ID", "product_ID", "quantity"]
    assert lines.count() == sum(len(c["products"]) for c in golden.CARTS) == 7
    assert {r.User_ID for r in lines.collect()} == {1, 2, 3, 4}


def test_flat_columns(flat):
    _, products, users = flat
    assert products.columns == ["category", "description", "Product_ID", "image", "price", "count", "rate", "title"]
    assert users.columns == [
        "__V", "city", "lat", "long", "number", "street", "zipcode", "email", "User_ID", "firstname", "lastname",
        "password", "phone", "username",
    ]
    assert rows(users.where("User_ID = 3").select("city", "lat", "long", "number", "firstname")) == [
        ("Rome", "1.0", "2.0", 3, "Cy")
    ]


@pytest.mark.parametrize("name", METRICS)
def test_metric_from_rollups(flat, name):
    metric = METRICS[name]
    per_product, per_buyer = product_sales(*flat), buyer_sales(*flat)
    result = metric.compute(per_product if metric.source == "product" else per_buyer)
    assert result.columns[-1] == metric.output
    assert rows(result) == golden.EXPECTED[name]


@pytest.mark.parametrize("name", METRICS)
def test_metric_from_single_lines(flat, name):
    assert rows(METRICS[name].compute(line_measures(enrich(*flat)))) == golden.EXPECTED[name]


def test_owner_is_another_buyer(documents, flat):
    lines = sale_lines(documents["carts"], buyer_col="userId")
    result = METRICS["revenue_by_users_ID"].compute(buyer_sales(lines, flat[1], flat[2]))
    assert [(r.User_ID, r.total_revenue_byUser) for r in result.collect()] == [(1, 110.49), (3, 72.5), (2, 60.0)]


def test_repeated_ids_multiply_lines_on_every_route(flat):
    lines, products, users = flat
    products = products.unionByName(products.where("Product_ID = 1"))
    users = users.unionByName(users.where("User_ID = 3")).unionByName(users.where("User_ID = 3"))
    wide = line_measures(enrich(lines, products, users))
    # lines 7, product 1 twice (carts 1 and 3), buyer 3 three times
    assert wide.count() == 3 + 2 + 1 + (2 + 1) * 3
    for metric in METRICS.values():
        sales = (product_sales if metric.source == "product" else buyer_sales)(lines, products, users)
        assert rows(metric.compute(sales)) == rows(metric.compute(wide))


def test_dedupe_undoes_repeats(flat):
    lines, products, users = flat
    twice = products.unionByName(products), users.unionByName(users)
    for metric in METRICS.values():
        sales = (product_sales if metric.source == "product" else buyer_sales)(lines, *twice, dedupe_dims=True)
        assert rows(metric.compute(sales)) == golden.EXPECTED[metric.name]
        assert rows(metric.compute(line_measures(enrich(lines, *twice, dedupe_dims=True)))) == golden.EXPECTED[metric.name]


def test_no_rows(spark, flat):
    lines = flat[0].where("quantity < 0")
    sales = {"product": product_sales(lines, *flat[1:]), "buyer": buyer_sales(lines, *flat[1:])}
    for metric in METRICS.values():
        assert rows(metric.compute(sales[metric.source])) == ([(None,)] if not metric.keys else [])


def test_null_product_and_quantity(spark, flat):
    extra = spark.createDataFrame(
        [(1, None, 2, 9), (1, 1, None, 9), (None, 2, 1, 9)], flat[0].schema
    )
    lines = flat[0].unionByName(extra)
    wide = line_measures(enrich(lines, *flat[1:]))
    for metric in METRICS.values():
        sales = (product_sales if metric.source == "product" else buyer_sales)(lines, *flat[1:])
        assert rows(metric.compute(sales)) == rows(metric.compute(wide))


def land(documents, base, days):
    for kind in ("products", "users"):
        assert landing.land_weekly(documents[kind], base, kind, DAY)
    for day in days:
        landing.land_carts(documents["carts"], base, day)


def published(spark, base, name, day):
    metric = METRICS[name]
    table = publish.read_published(spark, base, name, day, day)
    return rows(table.orderBy(*metric.order()).select(*metric.keys, metric.output))


def stored(spark, base, name):
    return warehouse.read_warehouse(spark, base, name)


def test_run_day(spark, documents, tmp_path):
    base = str(tmp_path)
    land(documents, base, [DAY])
    run_day(spark, base, DAY)
    for name, expected in golden.EXPECTED.items():
        assert published(spark, base, name, DAY) == expected
        keyed = stored(spark, base, name)
        metric = METRICS[name]
        got = sorted(rows(keyed.select("date_id", *metric.keys, metric.output)))
        assert got == sorted((f"{DAY}_{n}", *row) for n, row in enumerate(expected, start=1))
    before = {name: stored(spark, base, name).count() for name in METRICS}
    run_day(spark, base, DAY)
    assert before == {name: stored(spark, base, name).count() for name in METRICS}


def test_run_history_equals_single_days(spark, documents, tmp_path):
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    for base in (one, many):
        land(documents, base, [DAY, NEXT])
        landing.land_carts(documents["carts"].where("id <> 3"), base, NEXT)
    run_day(spark, one, DAY)
    run_day(spark, one, NEXT)
    run_history(spark, many, DAY, NEXT)
    for name in METRICS:
        for day in (DAY, NEXT):
            assert published(spark, one, name, day) == published(spark, many, name, day)
        columns = sorted(stored(spark, one, name).columns)
        assert sorted(map(str, rows(stored(spark, one, name).select(columns)))) == sorted(
            map(str, rows(stored(spark, many, name).select(columns)))
        )


def test_later_day_leaves_earlier_day_alone(spark, documents, tmp_path):
    base = str(tmp_path)
    land(documents, base, [DAY, NEXT])
    run_history(spark, base, DAY, DAY)
    first = rows(stored(spark, base, "rev_prod_cat"))
    run_history(spark, base, NEXT, NEXT)
    assert published(spark, base, "rev_prod_cat", DAY) == golden.EXPECTED["rev_prod_cat"]
    again = stored(spark, base, "rev_prod_cat")
    assert sorted(map(str, rows(again.where(f"static_date = '{DAY}'")))) == sorted(map(str, first))
    assert again.count() == 2 * len(first)


def test_missing_inputs_are_named(spark, documents, tmp_path):
    base = str(tmp_path)
    with pytest.raises(raw.MissingInput, match="carts"):
        run_day(spark, base, DAY)
    land(documents, base, [DAY, date(2025, 4, 21)])
    with pytest.raises(raw.MissingInput, match="iso_week=17"):
        run_day(spark, base, date(2025, 4, 21))
    with pytest.raises(MissingSnapshot, match="2025/17"):
        run_history(spark, base, DAY, date(2025, 4, 21))


def test_checks_name_the_gap(spark, documents, tmp_path):
    base = str(tmp_path)
    land(documents, base, [DAY])
    run_day(spark, base, DAY)
    publish.check_day(spark, base, DAY)
    with pytest.raises(publish.MissingOutput, match="2025-04-15"):
        publish.check_day(spark, base, NEXT)
    publish.check_days(spark, base, [DAY])
    with pytest.raises(publish.MissingOutput, match="2025-04-15"):
        publish.check_days(spark, base, [DAY, NEXT])
    # Files are compared with what the run wrote.
    folder = next((tmp_path / "analytics").glob("run=*")) / "ord_bycity"
    file = next(folder.glob("part-*.parquet"))
    twice = folder / "part-99999-twice.parquet"
    twice.write_bytes(file.read_bytes())
    with pytest.raises(publish.MissingOutput, match="ord_bycity.*part-99999-twice.parquet was not written by its run"):
        publish.check_day(spark, base, DAY)
    twice.unlink()
    publish.check_day(spark, base, DAY)
    file.write_bytes(file.read_bytes()[:-5])
    with pytest.raises(publish.MissingOutput, match=f"{file.name} has another length"):
        publish.check_day(spark, base, DAY)
    file.unlink()
    with pytest.raises(publish.MissingOutput, match=f"{file.name} is missing"):
        publish.check_days(spark, base, [DAY])


def test_day_without_carts(spark, documents, tmp_path):
    """An empty day replaces what was there and gives one NULL total."""
    base = str(tmp_path)
    land(documents, base, [DAY])
    run_day(spark, base, DAY)
    landing.land_carts(documents["carts"].where("id = 5"), base, DAY)
    run_day(spark, base, DAY)
    for name, metric in METRICS.items():
        assert published(spark, base, name, DAY) == ([(None,)] if not metric.keys else [])


def test_history_with_a_day_without_sales(spark, documents, tmp_path):
    base = str(tmp_path)
    land(documents, base, [DAY])
    landing.land_carts(documents["carts"].where("id = 5"), base, NEXT)
    run_history(spark, base, DAY, NEXT)
    assert published(spark, base, "total_day_revenue", NEXT) == [(None,)]
    assert published(spark, base, "rev_prod_cat", NEXT) == []
    assert published(spark, base, "total_day_revenue", DAY) == golden.EXPECTED["total_day_revenue"]


def test_history_run_empties_a_day_that_lost_its_sales(spark, documents, tmp_path):
    """Landed again without any product, on both routes, and no scratch file is left."""
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    for base, run in ((one, lambda: run_day(spark, one, DAY)), (many, lambda: run_history(spark, many, DAY, DAY))):
        land(documents, base, [DAY])
        run()
        landing.land_carts(documents["carts"].where("id = 5"), base, DAY)
        run()
        for name, metric in METRICS.items():
            assert published(spark, base, name, DAY) == ([(None,)] if not metric.keys else [])
    for name in METRICS:
        assert stored(spark, one, name).count() == stored(spark, many, name).count()


def test_only_changed_days_run_again(spark, documents, tmp_path):
    """After any change the tables are those of a full run, and only the days it touches were computed."""
    delta, full, last = str(tmp_path / "delta"), str(tmp_path / "full"), date(2025, 4, 21)
    days = [DAY, NEXT, last]
    for base in (delta, full):
        land(documents, base, days)
        for kind in ("products", "users"):
            landing.land_weekly(documents[kind], base, kind, last)

    def same():
        run_history(spark, full, DAY, last)
        for name in METRICS:
            for day in days:
                assert published(spark, delta, name, day) == published(spark, full, name, day)
        publish.check_days(spark, delta, days)

    assert runs.run_changes(spark, delta, DAY, last) == days
    assert runs.run_changes(spark, delta, DAY, last) == []
    same()
    for base in (delta, full):
        landing.land_carts(documents["carts"].where("id <> 3"), base, NEXT)
    assert runs.run_changes(spark, delta, DAY, last) == [NEXT]
    same()
    # The snapshot of a week: with the same rows nothing changes, with another price the days of that week do.
    week = {"iso_year": 2025, "iso_week": 17}
    path = zones.zone(delta, "raw", "products")
    zones.replace_partition(documents["products"].repartition(3), path, week)
    assert runs.run_changes(spark, delta, DAY, last) == []
    for base in (delta, full):
        zones.replace_partition(documents["products"].withColumn("price", F.col("price") * 2), zones.zone(base, "raw", "products"), week)
    assert runs.run_changes(spark, delta, DAY, last) == [last]
    same()
    # A range without the change, another option, a day that is not published.
    assert runs.run_changes(spark, delta, DAY, NEXT) == []
    assert runs.run_changes(spark, delta, DAY, NEXT, buyer_col="userId") == [DAY, NEXT]
    assert runs.run_changes(spark, str(tmp_path / "none"), DAY, NEXT) == []


def test_positional_rerun_with_a_gap_joins_keys(spark, tmp_path):
    metric = METRICS["num_of_prod_sold"]
    rows_of = lambda *v: warehouse.position_rows(metric, spark.createDataFrame([(DAY, p, n) for p, n in v], "run_date date, product_ID long, Num_prod_sold long"))
    full = rows_of((1, 9), (2, 8), (3, 7))
    stored_rows = full.where(f"date_id <> '{DAY}_2'")
    got = warehouse.after_load(rows_of((1, 9), (2, 5), (3, 7)), stored_rows, by_content=False)
    assert sorted(rows(got.select("date_id", "product_ID"))) == [(f"{DAY}_1", 1), (f"{DAY}_2", 3), (f"{DAY}_3", 3)]


def test_positional_rerun_keeps_what_is_stored(spark, tmp_path):
    metric = METRICS["total_quantity_per_prod"]

    def keyed(*values):
        df = spark.createDataFrame([(DAY, p, "c", q) for p, q in values], "run_date date, Product_ID long, category string, quantity_per_productID long")
        return warehouse.position_rows(metric, df)

    path = str(tmp_path / "table")
    for _ in range(2):
        warehouse.load(keyed((1, 10), (2, 5)), path, DAY, DAY, by_content=False)
    rerun = keyed((2, 50), (1, 10), (3, 1))
    stored_rows = warehouse.read_stored(rerun, path)
    expected = [(f"{DAY}_1", 1, 10), (f"{DAY}_2", 2, 5), (f"{DAY}_3", 3, 1)]
    columns = ["date_id", "Product_ID", "quantity_per_productID"]
    assert sorted(rows(warehouse.after_load(rerun, stored_rows, by_content=False).select(columns))) == expected
    for _ in range(2):
        warehouse.load(rerun, path, DAY, DAY, by_content=False)
    assert sorted(rows(warehouse.read_stored(rerun, path).select(columns))) == expected


def test_content_rerun_keeps_both_versions(spark, tmp_path):
    def keyed(*values):
        return warehouse.content_rows(spark.createDataFrame([(DAY, *v) for v in values], "run_date date, a string, b string, n long"))

    path = str(tmp_path / "table")
    # Fields that read the same when simply joined, and a NULL next to its mark.
    first = [("x|y", "z", 1), ("x", "y|z", 1), (None, "-", 1), ("-", None, 1)]
    warehouse.load(keyed(*first), path, DAY, DAY)
    warehouse.load(keyed(*first), path, DAY, DAY)
    assert warehouse.read_stored(keyed(*first), path).count() == 4
    warehouse.load(keyed(("x|y", "z", 2)), path, DAY, DAY)
    assert warehouse.read_stored(keyed(*first), path).count() == 5


def test_content_keyed_run(spark, documents, tmp_path):
    base = str(tmp_path)
    land(documents, base, [DAY])
    run_day(spark, base, DAY, by_content=True)
    run_day(spark, base, DAY, by_content=True)
    for name, expected in golden.EXPECTED.items():
        assert stored(spark, base, name).count() == len(expected)
