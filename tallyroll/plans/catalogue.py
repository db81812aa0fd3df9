"""Named queries over the test tables, one per operator and metric.

Each takes the session and the folder of the tables. ``plans.reference_sql`` holds the SQL
that gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from datetime import date
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.functions import calendar, money
from tallyroll.operators.enrich import PRODUCT_FIELDS, USER_FIELDS, enrich
from tallyroll.operators.flatten import cart_lines, flatten_products, flatten_users
from tallyroll.operators.flatten import sale_lines as explode_sale_lines
from tallyroll.operators.rollups import buyer_sales, product_sales
from tallyroll.operators.validity import VALID, intervals
from tallyroll.plans import publish, warehouse
from tallyroll.plans.metrics import METRICS, Metric
from tallyroll.plans.runs import run_changes, run_day, run_history
from tallyroll.session import TASK_ROWS, fit_tasks, scratch_path, settle
from tallyroll.sources import landing, raw, zones
from tallyroll.sources import starschema as star

Query = Callable[[SparkSession, str], DataFrame]

# Metrics that are also computed with dimensions as intervals.
VALIDITY_METRICS = {"m02": "revenue_by_users_ID", "m06": "avg_rat_per_cat", "m09": "rev_prod_cat"}

# Fixed value: the run date of the queries that stamp one.
STAMP_DATE = "2025-04-14"


def _dims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return flatten_products(star.products(spark, sf_dir)), flatten_users(star.users(spark, sf_dir))


def _weekly_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_products(star.weekly_products(spark, sf_dir), keep=calendar.WEEK_KEY)


def _weekly_users(spark: SparkSession, sf_dir: str, ordered: DataFrame | None = None) -> DataFrame:
    return flatten_users(star.weekly_users(spark, sf_dir, ordered), keep=calendar.WEEK_KEY)


# What weekly users take of an order line besides what a sale line does, and what the first load does.
ACTIVE_BY, LOADED_BY = ("o_custkey", "l_shipdate"), ("l_returnflag",)


def _ordered(spark: SparkSession, sf_dir: str, also: Collection[str]) -> DataFrame:
    """The lines with their orders, written down: for queries that would join them more than once."""
    return settle(star.ordered_lines(spark, sf_dir, *also), "ordered")


def _snapshot(dim: DataFrame, *columns: str) -> DataFrame:
    """Some columns of a weekly dimension, written down: a join with single lines reads it twice."""
    return settle(dim.select(*calendar.WEEK_KEY, *columns), "snapshot")


def sales(
    metric: Metric,
    spark: SparkSession,
    sf_dir: str,
    dated: bool = False,
    owner: bool = True,
    where: str | None = None,
    monthly: bool = False,
    ordered: DataFrame | None = None,
) -> DataFrame:
    """The rollup of one metric. Ids are primary keys in these tables, hence no check for repeats."""
    options = {"by": ("run_date",) if dated else (), "by_id": metric.by_id}
    if metric.source == "product":
        lines = star.sale_lines(spark, sf_dir, dated=dated, where=where, monthly=monthly, ordered=ordered)
        return product_sales(lines, flatten_products(star.products(spark, sf_dir)), **options)
    lines = star.sale_lines(spark, sf_dir, owner=owner, dated=dated, where=where, monthly=monthly, ordered=ordered)
    return buyer_sales(lines, *_dims(spark, sf_dir), **options)


def metric_query(metric: Metric, spark: SparkSession, sf_dir: str, dated: bool = False, owner: bool = True) -> DataFrame:
    rollup = sales(metric, spark, sf_dir, dated, owner)
    return metric.compute(rollup, by=("run_date",) if dated else (), ordered=not dated)


def weekly_metric_query(metric: Metric, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metric per day where each day meets the snapshots of its own ISO week."""
    products = _weekly_products(spark, sf_dir)
    lines = star.sale_lines(spark, sf_dir, owner=metric.source == "buyer", dated=True)
    options = {"by": ("run_date",), "weekly": True}
    if metric.source == "product":
        rollup = product_sales(lines, products, **options)
    else:
        prices = _snapshot(products, "Product_ID", "price")
        rollup = buyer_sales(lines, prices, _weekly_users(spark, sf_dir), **options)
    return metric.compute(rollup, by=("run_date",), ordered=False)


def users_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_users(star.users(spark, sf_dir))


def products_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_products(star.products(spark, sf_dir))


def lines_of_carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cart_lines(star.carts(spark, sf_dir))


def lines_of_buyers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cart_lines(star.carts(spark, sf_dir), buyer_col="userId")


def enriched(spark: SparkSession, sf_dir: str, owner: bool) -> DataFrame:
    return enrich(star.sale_lines(spark, sf_dir, owner=owner), *_dims(spark, sf_dir))


def enriched_by_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Written down, since both joins look for hot keys in the lines before they join them.
    lines = settle(star.sale_lines(spark, sf_dir, owner=True, dated=True), "lines")
    products = _snapshot(_weekly_products(spark, sf_dir), "Product_ID", *PRODUCT_FIELDS)
    users = _snapshot(_weekly_users(spark, sf_dir), "User_ID", *USER_FIELDS)
    return enrich(lines, products, users, by=("run_date",), weekly=True)


def validity_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly users as intervals of weeks without a change."""
    return intervals(_weekly_users(spark, sf_dir).select(*calendar.WEEK_KEY, "User_ID", *USER_FIELDS), "User_ID").withColumns({c: F.col(c).cast("bigint") for c in VALID})


def _valid(dim: DataFrame, key: str, *columns: str) -> DataFrame:
    """Some columns of a weekly dimension as intervals, written down: a join reads them twice."""
    return settle(intervals(dim.select(*calendar.WEEK_KEY, key, *columns), key), "intervals")


def enriched_by_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``enriched_by_week`` with both dimensions as intervals."""
    # Lines and orders are joined once, for the lines, the looks for hot keys in them and the weekly users.
    ordered = _ordered(spark, sf_dir, ACTIVE_BY)
    lines = star.sale_lines(spark, sf_dir, owner=True, dated=True, ordered=ordered)
    products = _valid(_weekly_products(spark, sf_dir), "Product_ID", *PRODUCT_FIELDS)
    users = _valid(_weekly_users(spark, sf_dir, ordered), "User_ID", *USER_FIELDS)
    return enrich(lines, products, users, by=("run_date",), weekly=True)


def validity_metric_query(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """``weekly_metric_query`` with the dimensions as intervals."""
    metric, options = METRICS[name], {"by": ("run_date",), "weekly": True}
    buyer = metric.source == "buyer"
    # Buyers need the lines' orders also for the weekly users.
    ordered = _ordered(spark, sf_dir, ACTIVE_BY) if buyer else None
    lines = star.sale_lines(spark, sf_dir, owner=buyer, dated=True, ordered=ordered)
    if not buyer:
        rollup = product_sales(lines, _valid(_weekly_products(spark, sf_dir), "Product_ID", *PRODUCT_FIELDS), **options)
    else:
        prices = _valid(_weekly_products(spark, sf_dir), "Product_ID", "price")
        rollup = buyer_sales(lines, prices, _valid(_weekly_users(spark, sf_dir, ordered), "User_ID", *USER_FIELDS), **options)
    return metric.compute(rollup, by=("run_date",), ordered=False)


def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("run_date")).distinct()


def iso_week_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("run_date")
    return _order_days(spark, sf_dir).select(
        calendar.day_label(day).alias("day"),
        calendar.iso_year(day).cast("bigint").alias("iso_year"),
        calendar.iso_week(day).cast("bigint").alias("iso_week"),
        calendar.week_label(day).alias("week_folder"),
    )


def monday_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("run_date")
    return _order_days(spark, sf_dir).select(
        day, calendar.refresh_due(day).alias("due"), calendar.refresh_due(day, force=True).alias("due_if_forced")
    )


def date_stamped_carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = landing.stamp_carts(star.carts(spark, sf_dir), calendar.parse_day(STAMP_DATE))
    return stamped.select("id", "date", F.size("products").cast("bigint").alias("n_products"))


def _daily_rows(metric: Metric, spark: SparkSession, sf_dir: str, where: str | None = None, monthly: bool = False, ordered: DataFrame | None = None) -> DataFrame:
    rollup = sales(metric, spark, sf_dir, dated=True, where=where, monthly=monthly, ordered=ordered)
    return metric.compute(rollup, by=("run_date",), ordered=False)


def date_id_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    metric = METRICS["rev_prod_cat"]
    return warehouse.position_rows(metric, _daily_rows(metric, spark, sf_dir))


# The first load of the re-run queries came before the returned lines were known.
FIRST_LOAD = "l_returnflag <> 'R'"


def warehouse_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    metric = METRICS["total_quantity_per_prod"]
    stored = settle(warehouse.position_rows(metric, _daily_rows(metric, spark, sf_dir, FIRST_LOAD)), "stored")
    rerun = warehouse.position_rows(metric, _daily_rows(metric, spark, sf_dir))
    return warehouse.after_load(rerun, stored, by_content=False)


def warehouse_rerun_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    metric, ordered = METRICS["total_quantity_per_prod"], _ordered(spark, sf_dir, LOADED_BY)
    stored = settle(warehouse.content_rows(_daily_rows(metric, spark, sf_dir, FIRST_LOAD, ordered=ordered)), "stored")
    # Dealt to the tasks of the join without their keys, which are longer than all fields.
    rerun = warehouse.content_rows(_daily_rows(metric, spark, sf_dir, ordered=ordered), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return warehouse.after_load(rerun, stored)


def warehouse_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of monthly rows into a table that doesn't exist at first, and the second one again."""
    metric, path = METRICS["total_quantity_per_prod"], scratch_path(spark, "warehouse")
    month = F.trunc("run_date", "month")
    first, last = _order_days(spark, sf_dir).agg(F.min(month), F.max(month)).first()
    for where in (FIRST_LOAD, None, None):
        rows = warehouse.position_rows(metric, _daily_rows(metric, spark, sf_dir, where, monthly=True))
        warehouse.load(rows, path, first, last, by_content=False)
    return warehouse.read_stored(rows, path)


def warehouse_daily_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loads of ``warehouse_load`` with the rows of each day, a partition for each."""
    metric, path = METRICS["total_quantity_per_prod"], scratch_path(spark, "warehouse")
    first, last = _order_days(spark, sf_dir).agg(F.min("run_date"), F.max("run_date")).first()
    for where in (FIRST_LOAD, None, None):
        rows = warehouse.position_rows(metric, _daily_rows(metric, spark, sf_dir, where))
        warehouse.load(rows, path, first, last, by_content=False)
    return warehouse.read_stored(rows, path)


# Buckets of the keyed store at least; the test tables are small, so its files are never taken for small ones.
STORE_BUCKETS = 16


def warehouse_keyed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads of daily rows, keyed by content, into a table in buckets: some of the rows, all, and all again."""
    metric, path = METRICS["total_quantity_per_prod"], scratch_path(spark, "warehouse")
    first, last = _order_days(spark, sf_dir).agg(F.min("run_date"), F.max("run_date")).first()
    buckets = max(STORE_BUCKETS, -(-star.table(spark, sf_dir, "lineitem").count() // TASK_ROWS))
    ordered = _ordered(spark, sf_dir, LOADED_BY)
    for where in (FIRST_LOAD, None, None):
        rows = warehouse.content_rows(_daily_rows(metric, spark, sf_dir, where, ordered=ordered), buckets)
        warehouse.load(rows, path, first, last, buckets=buckets, small_bytes=0)
    return warehouse.read_stored(rows, path)


def _all_published(spark: SparkSession, base: str, first: date, last: date, sold: bool = False) -> DataFrame:
    """The rows of all twelve tables: metric, day, keys as one text, value; ``sold`` leaves out the row that a table without keys has for a day without a sale."""
    found, days = [], publish.read_published(spark, base, "num_of_prod_sold", first, last).select("run_date").distinct()
    for metric in METRICS.values():
        table = publish.read_published(spark, base, metric.name, first, last)
        if sold and not metric.keys:
            table = table.join(days, "run_date", "left_semi")
        key = F.concat_ws("|", *(F.coalesce(F.col(name).cast("string"), F.lit("-")) for name in metric.keys))
        found.append(table.select(F.lit(metric.name).alias("metric"), "run_date", key.alias("key"), F.col(metric.output).cast("double").alias("value")))
    return reduce(DataFrame.unionByName, found)


def _land_weeks(rows: DataFrame, base: str, kind: str, fields: Mapping[str, Column], days: Collection[date] = ()) -> None:
    """Land weekly snapshots, their documents made of ``rows`` behind the shuffle.

    There is one for each week of ``days``, also for those without rows: it has an id that no one buys, and null fields.
    """
    known = F.lit(True)
    if days:
        weeks = rows.sparkSession.createDataFrame(sorted({d.isocalendar()[:2] for d in days}), "iso_year int, iso_week int")
        rows = rows.withColumn("_known", known).unionByName(weeks.withColumn("id", F.lit(-1).cast("bigint")), allowMissingColumns=True)
        known = F.col("_known")
    landing.land_weekly_history(rows, base, kind, lambda dealt: dealt.select("id", *calendar.WEEK_KEY, *(F.when(known, column).alias(name) for name, column in fields.items())))


def history_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the carts of all days and the snapshots of all weeks; run the history; read all twelve tables back."""
    base, days = scratch_path(spark, "shop"), _days(spark, sf_dir)
    landing.land_carts_history(star.carts(spark, sf_dir), base)
    _land_weeks(star.weekly_product_rows(spark, sf_dir), base, "products", star.product_fields(weekly=True), days)
    _land_weeks(star.weekly_user_rows(spark, sf_dir), base, "users", star.user_fields(), days)
    run_history(spark, base, min(days), max(days), buyer_col="userId")
    return _all_published(spark, base, min(days), max(days), sold=True)


def history_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run without half of the carts of each month's 15th and with other prices in every tenth week; then both are landed as they are, and only that is run again."""
    base, days = scratch_path(spark, "shop"), _days(spark, sf_dir)
    carts, products, fields = star.carts(spark, sf_dir), star.weekly_product_rows(spark, sf_dir), star.product_fields(weekly=True)
    tenth, mid = F.col("iso_week") == 10, F.dayofmonth(F.to_date("date")) == 15
    landing.land_carts_history(carts.where(~mid | (F.col("id") % 2 == 0)), base)
    _land_weeks(products, base, "products", fields | {"price": fields["price"] + F.when(tenth, 1.0).otherwise(0.0)}, days)
    _land_weeks(star.weekly_user_rows(spark, sf_dir), base, "users", star.user_fields(), days)
    options = {"first": min(days), "last": max(days), "buyer_col": "userId"}
    run_changes(spark, base, **options)
    landing.land_carts_history(carts.where(mid), base)
    _land_weeks(products.where(tenth), base, "products", fields, [day for day in days if day.isocalendar()[1] == 10])
    run_changes(spark, base, **options)
    return _all_published(spark, base, min(days), max(days), sold=True)


def _days(spark: SparkSession, sf_dir: str, monthly: bool = False) -> list[date]:
    """One for each day, or month, of the table."""
    day = F.trunc("run_date", "month") if monthly else F.col("run_date")
    return [r.day for r in _order_days(spark, sf_dir).select(day.alias("day")).distinct().collect()]


def _stage_daily(spark: SparkSession, sf_dir: str, days: list[date], monthly: bool = False) -> Callable[[Metric, str], dict[str, int]]:
    return lambda metric, folder: publish.stage_days(metric, sales(metric, spark, sf_dir, dated=True, monthly=monthly), folder, days)


def publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    metric = METRICS["rev_prod_cat"]
    base, days = scratch_path(spark, "published"), _days(spark, sf_dir)
    publish.publish(spark, base, days, _stage_daily(spark, sf_dir, days), [metric])
    return publish.read_published(spark, base, metric.name, min(days), max(days)).select("run_date", *metric.keys, metric.output)


def day_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land all carts as those of one day, with that week's snapshots; run the day; read all twelve tables back."""
    base, day = scratch_path(spark, "shop"), calendar.parse_day(STAMP_DATE)
    landing.land_carts(star.carts(spark, sf_dir), base, day)
    landing.land_weekly(star.products(spark, sf_dir), base, "products", day)
    landing.land_weekly(star.users(spark, sf_dir), base, "users", day)
    run_day(spark, base, day, by_content=True)
    return _all_published(spark, base, day, day)


def published_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One year of the published days; the others are skipped by the files' statistics."""
    metric, base, days = METRICS["rev_prod_cat"], scratch_path(spark, "published"), _days(spark, sf_dir)
    publish.publish(spark, base, days, _stage_daily(spark, sf_dir, days), [metric])
    year = publish.read_published(spark, base, metric.name, date(1995, 1, 1), date(1995, 12, 31))
    return year.select("run_date", *metric.keys, metric.output)


def table_of_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of published tables, each named by the path of its files."""
    base, days = scratch_path(spark, "published"), _days(spark, sf_dir, monthly=True)
    names = ("revenue_by_category", "total_day_revenue")
    publish.publish(spark, base, days, _stage_daily(spark, sf_dir, days, monthly=True), [METRICS[name] for name in names])
    found = [publish.read_published(spark, base, name, min(days), max(days)).select("_metadata.file_path") for name in names]
    return found[0].unionByName(found[1]).groupBy(zones.table_name(F.col("file_path")).alias("table_name")).agg(F.count(F.lit(1)).alias("n_rows"))


def published_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the published tables as counted when they were written and as read, and whether the digests agree."""
    base, days = scratch_path(spark, "published"), _days(spark, sf_dir)
    names = ("rev_prod_cat", "revenue_by_category", "total_day_revenue")
    publish.publish(spark, base, days, _stage_daily(spark, sf_dir, days), [METRICS[name] for name in names])
    found = publish.contents(spark, base, days)
    rows = {f"rows_{kind}": F.substring_index(kind, ":", 1).cast("bigint") for kind in ("written", "found")}
    return found.select("table_name", *(rows[name].alias(name) for name in rows), (F.col("written") == F.col("found")).alias("same"))


def fine_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by category with prices of six decimal places."""
    fine = flatten_products(star.products(spark, sf_dir)).join(star.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("Product_ID"), "p_size"), "Product_ID")
    fine = fine.withColumn("price", F.col("price") + F.col("p_size") / F.lit(1e6)).drop("p_size")
    places, metric = money.places_needed(fine), METRICS["revenue_by_category"]
    return metric.compute(product_sales(star.sale_lines(spark, sf_dir), fine, places=places), places=places)


def any_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by category, total and mean price by user with prices of very different size, a third of them without an end."""
    size, price = F.col("Product_ID") % 4, F.col("price")
    products, users = _dims(spark, sf_dir)
    priced = F.when(size == 0, price / F.lit(3.0)).when(size == 1, price * F.lit(1e-7)).when(size == 2, price * F.lit(1e5)).otherwise(price)
    products = settle(products.withColumn("price", priced), "priced")
    places, found = money.places_needed(products), []
    lines = star.sale_lines(spark, sf_dir, owner=True)
    sums = {"product": product_sales(lines, products, places=places), "buyer": buyer_sales(lines, products, users, places=places)}
    for name in ("revenue_by_category", "total_day_revenue", "avg_ordval_per_user"):
        metric = METRICS[name]
        key = F.col(metric.keys[0]).cast("string") if metric.keys else F.lit(None).cast("string")
        found.append(metric.compute(sums[metric.source], ordered=False, places=places).select(F.lit(name).alias("metric"), key.alias("key"), F.col(metric.output).alias("value")))
    return found[0].unionByName(found[1]).unionByName(found[2])


def json_arrays(kind: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as files of one indented JSON array each, read back and flattened."""
    path = scratch_path(spark, "json")
    raw.write_json_arrays({"users": star.users, "products": star.products, "carts": star.carts}[kind](spark, sf_dir), path)
    flat = {"users": flatten_users, "products": flatten_products, "carts": cart_lines}[kind]
    return flat(raw.read_raw(spark, kind, path))


# Which of the documents and files below are damaged: a quantity of 2.5 in every 97th cart with products, and every
# seventh file, counted from the third, cut off.
CARTS_PER_FILE, ODD_CART, CUT_FILE, FIRST_CUT = 500, 97, 7, 3


def raw_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of cart arrays with planted damage, read into documents and quarantine."""
    base, carts = scratch_path(spark, "incoming"), star.carts(spark, sf_dir)
    whole = F.to_json(F.struct(*carts.columns))
    odd = F.regexp_replace(whole, r'^(.*?"quantity":)\d+', "$1 2.5")
    document = F.when(F.col("id") % ODD_CART == 0, odd).otherwise(whole)
    files = carts.select(F.expr(f"id div {CARTS_PER_FILE}").alias("file"), "id", document.alias("document")).groupBy("file")
    arrays = files.agg(F.sort_array(F.collect_list(F.struct("id", "document"))).alias("d"))
    text = F.concat(F.lit("[\n"), F.array_join(F.transform("d", lambda d: d["document"]), ",\n"), F.lit("\n]"))
    cut = F.substring(text, F.lit(1), F.length(text) - 10)
    arrays = arrays.select("file", F.when(F.col("file") % CUT_FILE == FIRST_CUT, cut).otherwise(text).alias("value"))
    arrays.write.option("maxRecordsPerFile", 1).partitionBy("file").text(f"{base}/carts")
    read = raw.read_raw(spark, "carts", f"{base}/carts", quarantine=f"{base}/quarantine")
    aside = raw.read_quarantine(spark, f"{base}/quarantine")
    number = F.coalesce(F.get_json_object("text", "$.id"), F.regexp_extract("file", "file=(\\d+)", 1))
    file = F.when(F.col("reason") == raw.UNREADABLE, F.regexp_extract("file", "file=(\\d+)", 1)).otherwise(number)
    return read.select("id", F.size("products").cast("bigint").alias("n_products"), F.lit("read").alias("state")).unionByName(
        aside.select(file.cast("bigint").alias("id"), F.lit(None).cast("bigint").alias("n_products"), F.col("reason").alias("state"))
    )


def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "landed")
    landing.land_carts_history(star.carts(spark, sf_dir), base)
    return explode_sale_lines(landing.read_carts(spark, base), "userId", by=("run_date",))


def weekly_landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "landed")
    _land_weeks(star.weekly_product_rows(spark, sf_dir), base, "products", star.product_fields(weekly=True))
    landed = zones.read_table(spark, zones.zone(base, "raw", "products"))
    flat = flatten_products(landed, keep=calendar.WEEK_KEY)
    return flat.withColumns({name: F.col(name).cast("bigint") for name in calendar.WEEK_KEY})


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json")
    star.users(spark, sf_dir).write.json(path)
    return flatten_users(raw.read_raw(spark, "users", path, multi_line=False))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types are inferred, here those that were written but for whole numbers that fit into an int."""
    path = scratch_path(spark, "csv")
    lines = star.table(spark, sf_dir, "lineitem")
    lines = lines.withColumns({f.name: F.to_date(f.name) for f in lines.schema.fields if f.dataType.typeName().startswith("timestamp")})
    lines.write.csv(path, header=True)
    return raw.read_csv(spark, path)


def table_of_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table, the table named by the path of the file they come from."""
    tables = [star.table(spark, sf_dir, name).select("_metadata.file_path") for name in ("orders", "lineitem")]
    name = zones.table_name(F.col("file_path")).alias("table_name")
    return tables[0].unionByName(tables[1]).groupBy(name).agg(F.count(F.lit(1)).alias("n_rows"))


def _fitted(query: Query, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query in tasks that are as many as the lines call for; the count comes from the files' footers."""
    fit_tasks(spark, star.table(spark, sf_dir, "lineitem").count())
    return query(spark, sf_dir)


def catalogue() -> dict[str, Query]:
    found: dict[str, Query] = {
        "flatten_users": users_flat,
        "flatten_products": products_flat,
        "cart_lines": lines_of_carts,
        "cart_lines_owner": lines_of_buyers,
        "enrich_left": partial(enriched, owner=True),
        "enrich_cart_id": partial(enriched, owner=False),
        "enrich_by_week": enriched_by_week,
        "enrich_by_validity": enriched_by_validity,
        "validity_intervals": validity_intervals,
        **{f"{label}_by_day_validity": partial(validity_metric_query, name) for label, name in VALIDITY_METRICS.items()},
        "iso_week_partition": iso_week_partition,
        "monday_refresh": monday_refresh,
        "date_stamped_carts": date_stamped_carts,
        "date_id_rows": date_id_rows,
        "warehouse_rerun": warehouse_rerun,
        "warehouse_rerun_hash": warehouse_rerun_hash,
        "publish_roundtrip": publish_roundtrip,
        "landing_roundtrip": landing_roundtrip,
        "weekly_landing_roundtrip": weekly_landing_roundtrip,
        "json_roundtrip": json_roundtrip,
        "csv_roundtrip": csv_roundtrip,
        "raw_quarantine": raw_quarantine,
        "table_of_path": table_of_path,
        "table_of_published": table_of_published,
        "published_range": published_range,
        "published_contents": published_contents,
        "warehouse_load": warehouse_load,
        "warehouse_daily_roundtrip": warehouse_daily_roundtrip,
        "warehouse_keyed_load": warehouse_keyed_load,
        "history_roundtrip": history_roundtrip,
        "history_changes": history_changes,
        "day_roundtrip": day_roundtrip,
        "m01_fine_prices": fine_prices,
        "any_prices": any_prices,
        **{f"json_arrays_{kind}": partial(json_arrays, kind) for kind in ("users", "products", "carts")},
    }
    for number, metric in enumerate(METRICS.values(), start=1):
        label = f"m{number:02d}"
        found[f"{label}_{metric.name.lower()}"] = partial(metric_query, metric)
        found[f"{label}_by_day"] = partial(metric_query, metric, dated=True)
        if metric.source == "buyer":
            found[f"{label}_by_cart_id"] = partial(metric_query, metric, owner=False)
        found[f"{label}_by_day_weekly"] = partial(weekly_metric_query, metric)
    return {name: partial(_fitted, query) for name, query in found.items()}
