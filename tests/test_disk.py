"""What queries leave on disk and send through shuffles."""

import time

import pytest
from pyspark.sql import functions as F

from tallyroll.functions import keys
from tallyroll.operators import joins
from tallyroll.operators.rollups import buyer_sales
from tallyroll.plans import catalogue as plans
from tallyroll.plans import publish, warehouse
from tallyroll.session import DISK_SETTINGS, fit_tasks, settle, settled
from tallyroll.sources import starschema as star

DAY = "2020-01-01"


@pytest.fixture
def elsewhere(spark):
    """The session as one that was built without this library's settings."""
    before = {name: spark.conf.get(name) for name in DISK_SETTINGS}
    for name, value in zip(DISK_SETTINGS, ("false", "snappy", "1.0"), strict=True):
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.set(name, value)


def _shuffles(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_") and name.endswith(".data")}


def _waited(told, made):
    """``made()`` once ``told()`` says so, or after ten seconds: files go in the background."""
    for _ in range(100):
        if told():
            break
        time.sleep(0.1)
    return made()


def test_shuffles_leave_the_disk_with_their_query(elsewhere, tmp_path):
    spark = elsewhere
    fit_tasks(spark, 0)
    before, counted = _shuffles(spark), spark.range(50_000).groupBy((F.col("id") % 1009).alias("k")).count()
    counted.write.parquet(str(tmp_path / "t"))
    assert _waited(lambda: _shuffles(spark) <= before, lambda: _shuffles(spark)) <= before
    # A frame that is executed again makes its shuffle anew.
    assert sorted(counted.collect()) == sorted(counted.collect()) == sorted(spark.read.parquet(str(tmp_path / "t")).collect())


def test_files_are_packed(elsewhere):
    fit_tasks(elsewhere, 0)
    names = settle(elsewhere.range(9), "packed").inputFiles()
    assert names and all(name.endswith(".zstd.parquet") for name in names)


def _tables(spark, path, n=600):
    spark.range(n).selectExpr("id div 4 l_orderkey", "id % 50 l_partkey", "1.0D l_quantity", "id % 4 l_linenumber", "if(id % 3 = 0, 'R', 'N') l_returnflag", "date_add(date'1995-01-05', cast(id % 90 as int)) l_shipdate").write.parquet(f"{path}/lineitem.parquet")
    spark.range(n // 4).selectExpr("id o_orderkey", "id % 20 o_custkey", "date_add(date'1995-01-01', cast(id % 90 as int)) o_orderdate").write.parquet(f"{path}/orders.parquet")
    spark.range(50).selectExpr("id p_partkey", "'p' p_name", "'b' p_brand", "'t' p_type", "1 p_size", "1.5D p_retailprice").write.parquet(f"{path}/part.parquet")
    spark.range(20).selectExpr("id c_custkey", "concat('Customer#', id) c_name", "0L c_nationkey", "'m' c_mktsegment").write.parquet(f"{path}/customer.parquet")
    spark.range(1).selectExpr("id n_nationkey", "'n' n_name", "0L n_regionkey").write.parquet(f"{path}/nation.parquet")
    return str(path)


@pytest.mark.parametrize("name", ["enrich_by_validity", "m02_by_day_validity", "warehouse_rerun_hash", "warehouse_keyed_load"])
def test_lines_and_orders_are_joined_once(name, spark, tmp_path, monkeypatch):
    calls, real = [], star._ordered_lines
    monkeypatch.setattr(star, "_ordered_lines", lambda *args: calls.append(1) or real(*args))
    assert plans.catalogue()[name](spark, _tables(spark, tmp_path)).count() > 0
    assert len(calls) == 1


def test_hot_keys_are_looked_for_without_a_join(spark, tmp_path, monkeypatch):
    looked, real = [], joins.hot_keys
    monkeypatch.setattr(joins, "hot_keys", lambda fact, *args: looked.append(fact) or real(fact, *args))
    # No dimension counts as small, so both joins with intervals look.
    monkeypatch.setattr(joins, "measured_bytes", lambda df: 1 << 40)
    monkeypatch.setattr("tallyroll.operators.validity.measured_bytes", lambda df: 1 << 40)
    found = plans.catalogue()["enrich_by_validity"](spark, _tables(spark, tmp_path))
    assert found.count() == 600 and len(looked) >= 2
    assert not [fact for fact in looked if "Join" in fact._jdf.queryExecution().optimizedPlan().toString()]


def test_sums_by_day_are_not_searched_for_hot_keys(spark, tmp_path, monkeypatch):
    looked, real = [], joins.hot_keys
    monkeypatch.setattr(joins, "hot_keys", lambda fact, *args: looked.append(fact) or real(fact, *args))
    monkeypatch.setattr(joins, "measured_bytes", lambda df: 1 << 40)
    monkeypatch.setattr("tallyroll.operators.validity.measured_bytes", lambda df: 1 << 40)
    found = plans.catalogue()["m02_by_day_validity"](spark, _tables(spark, tmp_path))
    assert found.agg(F.count_distinct("run_date")).first()[0] == 90 and looked
    assert not [fact for fact in looked if "Aggregate" in fact._jdf.queryExecution().optimizedPlan().toString()]


def test_sums_of_buyers_are_written_down(spark):
    lines = spark.createDataFrame([(1, 7, 2, 1), (1, 8, 1, 1), (2, 7, 5, 2), (None, 7, 1, 3)], "User_ID long, product_ID long, quantity long, cart_id long")
    products = spark.createDataFrame([(7, 1.5), (8, 2.0)], "Product_ID long, price double")
    users = spark.createDataFrame([(1, "c", "e", "f", "l")], "User_ID long, city string, email string, firstname string, lastname string")
    kept = []
    with settled(spark) as keep:
        found = buyer_sales(lines, products, users, keep=lambda df, label: kept.append(label) or keep(df, label))
        assert sorted(map(str, found.collect())) == sorted(map(str, buyer_sales(lines, products, users).collect()))
    assert kept == ["buyer_sums"]


ODD_KEYS = [None, "", "x", f"{DAY}_{'ab' * 32}", f"_{'0f' * 32}", "ab" * 32, f"{DAY}_{'ab' * 32}\n", f"é\nb_{'ab' * 32}", f"{DAY}_{'AB' * 32}", f"{DAY}_17", "\x01" + "z" * 40]


def test_packed_keys_come_back(spark):
    table = spark.createDataFrame([(key,) for key in ODD_KEYS], "key string").withColumn("packed", keys.packed_key(F.col("key")))
    found = table.select("key", keys.unpacked_key(F.col("packed")).alias("back"), "packed").collect()
    assert [r.back for r in found] == ODD_KEYS
    assert len({bytes(r.packed) for r in found if r.packed is not None}) == len(ODD_KEYS) - 1
    assert len(found[3].packed) == 1 + 32 + len(DAY) + 1


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_rows_dealt_by_their_keys_are_shuffled_once(spark, no_broadcast, tmp_path):
    rows = spark.range(300).selectExpr("date_add(date'2020-01-01', cast(id % 7 as int)) run_date", "id product_ID", "id * 2 n")
    rows = rows.unionByName(rows.limit(1).selectExpr("cast(null as date) run_date", "product_ID", "n"))
    rows.write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    warehouse.content_rows(rows.where("n % 3 = 0")).write.parquet(f"{tmp_path}/stored")
    stored = spark.read.parquet(f"{tmp_path}/stored")
    dealt = warehouse.content_rows(rows, int(spark.conf.get("spark.sql.shuffle.partitions")))
    fresh = warehouse.fresh_rows(dealt, stored)
    plan = fresh._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange") == 2 and "Exchange hashpartitioning(date_id" not in plan
    # A row without a day has no key and is never found.
    assert sorted(fresh.select("product_ID").collect()) == sorted(rows.where("n % 3 <> 0 OR run_date IS NULL").select("product_ID").collect())
    plain = warehouse.fresh_rows(warehouse.content_rows(rows), stored)
    assert sorted(map(str, plain.collect())) == sorted(map(str, fresh.collect()))


def test_long_jobs_run_one_after_the_other(spark):
    name, cores = "spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism
    before = spark.conf.get(name)
    try:
        found = []
        for partitions in (1, cores, 2 * cores, 9 * cores):
            spark.conf.set(name, partitions)
            found.append(publish.side_by_side(spark))
        assert found == [publish.PARALLEL_JOBS, publish.PARALLEL_JOBS, publish.PARALLEL_JOBS // 2, 1]
    finally:
        spark.conf.set(name, before)
