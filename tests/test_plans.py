"""What the plans must keep: narrow scans, pruned partitions, no wide fact, no serial step."""

import re
from contextlib import redirect_stdout
from datetime import date
from io import StringIO

import pytest
from pyspark.sql import functions as F

import golden
from tallyroll.operators.flatten import cart_lines, sale_lines
from tallyroll.plans.catalogue import _land_weeks, catalogue
from tallyroll.sources import landing, raw, zones
from tallyroll.sources import starschema as star

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = StringIO()
    with redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def scanned(text: str, table: str) -> list[str]:
    """Columns read by each scan of a table."""
    return [m for m in re.findall(rf"{table}\.parquet\].*?ReadSchema: (struct<.*?>)(?:\n|$)", text)]


def test_product_metric_scans_two_fact_columns(spark):
    text = plan(catalogue()["m09_rev_prod_cat"](spark, SF_DIR))
    assert scanned(text, "lineitem") == ["struct<l_partkey:bigint,l_quantity:double>"]
    assert "customer.parquet" not in text and "orders.parquet" not in text


def test_fact_is_aggregated_before_the_attributes_are_joined(spark):
    text = plan(catalogue()["m09_rev_prod_cat"](spark, SF_DIR))
    join = text.index("Join")
    assert "partial_sum(units" in text[join:] and "Exchange hashpartitioning(product_ID" in text[join:]


def test_coarse_metric_shuffles_only_its_groups(spark):
    text = plan(catalogue()["m01_by_day"](spark, SF_DIR))
    assert re.findall(r"Exchange hashpartitioning\((\w+)#\d+, (\w+)", text) == [("run_date", "category")]


def test_buyer_attributes_meet_one_row_per_buyer(spark):
    text = plan(catalogue()["m02_revenue_by_users_id"](spark, SF_DIR))
    below_user_join = text[re.search(r"Join \[User_ID", text).start() :]
    assert re.search(r"HashAggregate\(keys=\[User_ID#\d+L?\], functions=\[partial_sum", below_user_join)
    assert scanned(text, "part") == ["struct<p_partkey:bigint,p_retailprice:double>"]


@pytest.mark.parametrize("name", ["m10_top_user_rev", "m11_top_prod_rev"])
def test_top_row_needs_no_total_sort(spark, name):
    text = plan(catalogue()[name](spark, SF_DIR))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


@pytest.mark.parametrize("name", ["m10_by_day", "m11_by_day"])
def test_daily_top_row_is_limited_before_the_shuffle(spark, name):
    assert re.search(r"WindowGroupLimit .*Partial", plan(catalogue()[name](spark, SF_DIR)))


def test_no_query_joins_everything_with_everything(spark):
    for name, query in catalogue().items():
        # Those that write and read back end in a plain scan.
        if not name.endswith("_roundtrip") and name not in ("warehouse_load", "published_range", "table_of_published", "history_changes"):
            text = plan(query(spark, SF_DIR))
            assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
            assert "SinglePartition" not in re.sub(r"HashAggregate\(keys=\[\].*\n.*SinglePartition", "", text), name


def test_landed_carts_are_pruned_by_day_and_field(spark, tmp_path):
    base = str(tmp_path)
    paths = golden.write_raw(tmp_path)
    landing.land_carts_history(raw.read_raw(spark, "carts", paths["carts"]), base)
    day = F.col("run_date") == F.lit("2020-03-02").cast("date")
    carts = landing.read_carts(spark, base).where(day)
    for lines in (cart_lines(carts), sale_lines(carts)):
        text = plan(lines.groupBy("product_ID").count())
        assert "ReadSchema: struct<products:array<struct<productId:bigint>>,run_date:date>" in text
        assert re.search(r"PushedFilters: \[.*EqualTo\(run_date,2020-03-02\)", text)


def test_documents_of_a_week_are_made_behind_the_shuffle(spark, tmp_path):
    sf, base, seen = str(tmp_path / "sf"), str(tmp_path / "shop"), []
    frames = {
        "nation": "select 1 n_nationkey, 'N' n_name, 2 n_regionkey",
        "customer": "select * from values (7L, 'C#7', 1, 'M'), (8L, null, 5, null) t(c_custkey, c_name, c_nationkey, c_mktsegment)",
        "orders": "select * from values (1L, 7L, timestamp'1995-01-02'), (2L, 8L, timestamp'1995-01-10') t(o_orderkey, o_custkey, o_orderdate)",
        "lineitem": "select o l_orderkey, 3L l_partkey, 2D l_quantity, 1 l_linenumber, d l_shipdate from values (1L, timestamp'1995-01-03'), (1L, timestamp'1995-01-04'), (2L, timestamp'1995-01-12') t(o, d)",
        "part": "select 3L p_partkey, 'p' p_name, 'b' p_brand, 't' p_type, 15 p_size, 9.5D p_retailprice",
    }
    for name, text in frames.items():
        spark.sql(text).write.parquet(f"{sf}/{name}.parquet")
    days = [date(1995, 1, 2), date(1995, 1, 20)]
    for kind, rows, fields, whole in (
        ("products", star.weekly_product_rows(spark, sf), star.product_fields(weekly=True), star.weekly_products(spark, sf)),
        ("users", star.weekly_user_rows(spark, sf), star.user_fields(), star.weekly_users(spark, sf)),
    ):
        _land_weeks(rows, base, kind, fields, days)
        found = zones.read_table(spark, f"{base}/raw/{kind}").select(*whole.columns)
        assert sorted(found.where("id <> -1").collect(), key=str) == sorted(whole.collect(), key=str)
        extra = found.where("id = -1")
        assert {(r.iso_year, r.iso_week) for r in extra.collect()} == {(1995, 1), (1995, 3)}
        assert all(v is None for r in extra.drop("id", "iso_year", "iso_week").collect() for v in r)

    def make(dealt):
        seen.append(dealt._jdf.queryExecution().logical().toString().lower())
        return dealt.select("iso_year", "iso_week", (F.col("id") * 2).alias("twice"))

    landing.land_weekly_history(spark.sql("select 1995 iso_year, 1 iso_week, 4L id"), base, "other", make)
    assert "rebalance" in seen[0]
    assert [r.twice for r in zones.read_table(spark, f"{base}/raw/other").collect()] == [8]
