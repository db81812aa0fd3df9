"""Tasks of the registered queries grow in number, not in size."""

import pytest
from pyspark.sql import functions as F

from tallyroll import session
from tallyroll.plans import catalogue as plans
from tallyroll.plans.catalogue import catalogue
from tallyroll.session import FILE_BYTES, TASK_BYTES, TASK_ROWS, fit_tasks

PARTITIONS, SIZE, FIRST = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.parallelismFirst"
LEAST = "spark.sql.adaptive.coalescePartitions.minPartitionSize"


@pytest.fixture
def elsewhere(spark):
    """The session as one that was built without this library's settings."""
    before = {name: spark.conf.get(name) for name in (PARTITIONS, SIZE, FIRST)}
    for name, value in {PARTITIONS: "2", SIZE: "64MB", FIRST: "true"}.items():
        spark.conf.set(name, value)
    yield spark
    spark.conf.unset(LEAST)
    for name, value in before.items():
        spark.conf.set(name, value)


def test_tasks_follow_the_lines(elsewhere, tmp_path):
    spark, n = elsewhere, 4 * TASK_ROWS
    line = spark.range(n).select((F.col("id") / 4).cast("bigint").alias("l_orderkey"), F.pmod(F.xxhash64("id"), F.lit(90001)).alias("l_partkey"), F.lit(1.0).alias("l_quantity"), F.lit(1).alias("l_linenumber"))
    line.write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = spark.range(n // 4).select(F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.date_add(F.lit("1995-01-01").cast("date"), F.pmod(F.hash("id"), F.lit(1500))).alias("o_orderdate"))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    part = spark.range(90001).selectExpr("id p_partkey", "'p' p_name", "'b' p_brand", "'t' p_type", "1 p_size", "1.5D p_retailprice")
    part.write.parquet(f"{tmp_path}/part.parquet")
    found = catalogue()["m08_by_day"](spark, str(tmp_path))
    sizes = found.groupBy(F.spark_partition_id().alias("task")).agg(F.sum("Num_prod_sold").alias("lines")).collect()
    assert sum(r.lines for r in sizes) == n
    assert len(sizes) > 2 and max(r.lines for r in sizes) <= 2 * TASK_ROWS


def test_a_finer_setting_stays(elsewhere):
    elsewhere.conf.set(SIZE, "16k")
    elsewhere.conf.set(PARTITIONS, "211")
    fit_tasks(elsewhere, 10 * TASK_ROWS)
    assert (elsewhere.conf.get(SIZE), elsewhere.conf.get(PARTITIONS), elsewhere.conf.get(FIRST)) == ("16k", "211", "false")
    for text in ("64MB", "64m", "67108864b", "67108864"):
        elsewhere.conf.set(SIZE, text)
        fit_tasks(elsewhere, 0)
        assert elsewhere.conf.get(SIZE) == str(TASK_BYTES)


def test_tasks_read_bounded_parts_of_files(elsewhere, tmp_path):
    spark, size, least = elsewhere, "spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum"
    before = {name: spark.conf.get(name, None) for name in (size, least)}
    try:
        spark.range(3 * FILE_BYTES // 8).selectExpr("xxhash64(id) h").coalesce(1).write.option("parquet.block.size", 1 << 20).parquet(str(tmp_path / "t"))
        spark.conf.set(size, "128MB")
        spark.conf.set(least, "1")  # as many as an input of any length has, however many cores there are
        fit_tasks(spark, 0)
        assert spark.read.parquet(str(tmp_path / "t")).groupBy(F.spark_partition_id()).count().count() >= 3
        spark.conf.set(size, "1m")
        fit_tasks(spark, 0)
        assert spark.conf.get(size) == "1m"
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@pytest.mark.parametrize("name", ["publish_roundtrip", "published_range", "published_contents", "m04_by_day", "warehouse_daily_roundtrip"])
def test_stored_and_published_rows_come_from_many_tasks(name, elsewhere, tmp_path, monkeypatch):
    spark, most, n = elsewhere, 5_000, 40_000
    monkeypatch.setattr(session, "TASK_ROWS", most)
    monkeypatch.setattr(plans, "scratch_path", lambda spark, label: str(tmp_path / label))
    # As with long tables, no partitions of a shuffle are small enough to be merged.
    spark.conf.set(SIZE, "1k")
    spark.conf.set(LEAST, "1k")
    line = ["id div 4 l_orderkey", "id l_partkey", "1.0D l_quantity", "id % 4 l_linenumber", "if(id % 3 = 0, 'R', 'N') l_returnflag"]
    spark.range(n).selectExpr(*line).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(n // 4).selectExpr("id o_orderkey", "id o_custkey", "date_add(date'1995-01-01', cast(id % 90 as int)) o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(n).selectExpr("id p_partkey", "'p' p_name", "'b' p_brand", "'t' p_type", "1 p_size", "1.5D p_retailprice").write.parquet(f"{tmp_path}/part.parquet")
    found = plans.catalogue()[name](spark, str(tmp_path))
    if name == "m04_by_day":
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    else:
        table = "warehouse/run=*" if name == "warehouse_daily_roundtrip" else "published/analytics/run=*/rev_prod_cat"
        sizes = [rows for path in tmp_path.glob(f"{table}/*.parquet") if (rows := spark.read.parquet(str(path)).count())]
    assert sum(sizes) == n and max(sizes) <= 1.5 * most
