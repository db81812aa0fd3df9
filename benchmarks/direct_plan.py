"""Time two ways to compute and write the twelve daily metrics of a landed history.

    python benchmarks/direct_plan.py <base uri> <first day> <last day> <direct|rollups> [buyer column]

``direct`` joins every line with all attributes, caches that wide fact and aggregates it twelve
times. ``rollups`` is what ``run_history`` does up to publishing. Both write to a scratch folder.
"""

from __future__ import annotations

import os
import sys
import time
from datetime import date
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark import StorageLevel

from tallyroll.functions.calendar import WEEK_KEY
from tallyroll.operators.enrich import product_dim, user_dim, with_week
from tallyroll.operators.flatten import flatten_products, flatten_users, sale_lines
from tallyroll.operators.rollups import buyer_sales, line_measures, product_sales
from tallyroll.plans import publish
from tallyroll.session import build_session, scratch_path, settle
from tallyroll.sources import landing, zones

DAY = ("run_date",)


def main() -> None:
    base, first, last, way = sys.argv[1], date.fromisoformat(sys.argv[2]), date.fromisoformat(sys.argv[3]), sys.argv[4]
    buyer_col = sys.argv[5] if len(sys.argv) > 5 else "id"
    spark = build_session(
        "direct_plan",
        f"local[{os.cpu_count()}]",
        **{"spark.sql.shuffle.partitions": "64", "spark.driver.memory": "18g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    out = scratch_path(spark, "benchmark")
    start = time.perf_counter()

    carts = landing.read_carts(spark, base, first, last)
    products = flatten_products(zones.read_table(spark, zones.zone(base, "raw", "products")), keep=WEEK_KEY)
    users = flatten_users(zones.read_table(spark, zones.zone(base, "raw", "users")), keep=WEEK_KEY)
    lines = sale_lines(carts, buyer_col, by=DAY)

    if way == "direct":
        wide = (
            with_week(lines)
            .join(product_dim(products, weekly=True), [*WEEK_KEY, "product_ID"], "left")
            .join(user_dim(users, weekly=True), [*WEEK_KEY, "User_ID"], "left")
            .drop("cart_id")
        )
        wide.persist(StorageLevel.MEMORY_AND_DISK)
        wide.write.format("noop").mode("overwrite").save()
        print("wide fact", round(time.perf_counter() - start, 1), flush=True)
        measures = line_measures(wide)
        sales = {"product": measures, "buyer": measures}
    else:
        sales = {
            "product": settle(product_sales(lines, products, users, by=DAY, weekly=True), "product_sales"),
            "buyer": settle(buyer_sales(lines, products, users, by=DAY, weekly=True), "buyer_sales"),
        }
        print("rollups", round(time.perf_counter() - start, 1), flush=True)

    days = [r.run_date for r in carts.select("run_date").distinct().collect()]
    publish.publish(spark, out, days, lambda m, folder: publish.stage_days(m, sales[m.source], folder, days))
    print(way, "total", round(time.perf_counter() - start, 1))


if __name__ == "__main__":
    main()
