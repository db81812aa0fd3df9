"""One-day and whole-history runs over the zones of a base URI."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.functions import money
from tallyroll.functions.calendar import WEEK_KEY
from tallyroll.operators.enrich import MissingSnapshot
from tallyroll.operators.flatten import flatten_products, flatten_users, sale_lines
from tallyroll.operators.rollups import buyer_sales, product_sales
from tallyroll.plans import publish, warehouse
from tallyroll.plans.metrics import METRICS, Metric
from tallyroll.session import settled
from tallyroll.sources import landing, zones

DAY = ("run_date",)


def load_warehouse(spark: SparkSession, base: str, first: date, last: date, by_content: bool = False, only: Collection[date] | None = None) -> None:
    """Load the published days, or some of them, into the warehouse tables."""

    def load(metric: Metric) -> None:
        rows = publish.read_published(spark, base, metric.name, first, last, only)
        with settled(spark) as keep:
            keyed = warehouse.content_rows(rows) if by_content else warehouse.position_rows(metric, rows, keep)
            warehouse.load(keyed, zones.zone(base, "warehouse", metric.name), first, last, by_content)

    publish.run_jobs([lambda metric=metric: load(metric) for metric in METRICS.values()], publish.side_by_side(spark))


def run_day(
    spark: SparkSession,
    base: str,
    run_date: date,
    buyer_col: str = "id",
    dedupe_dims: bool = False,
    by_content: bool = False,
) -> None:
    """Metrics of one landed day, published and loaded.

    Reads the carts of that day and the snapshots of its ISO week; any of them absent is an
    error. Both rollups are kept for the twelve metrics and released afterwards.
    """
    year, week, _ = run_date.isocalendar()
    snapshot = f"iso_year={year}/iso_week={week}"
    carts = landing.read_carts(spark, base, run_date, run_date)
    products = flatten_products(zones.read_table(spark, zones.zone(base, "raw", "products", snapshot)))
    users = flatten_users(zones.read_table(spark, zones.zone(base, "raw", "users", snapshot)))

    lines, places = sale_lines(carts, buyer_col), money.places_needed(products)
    per_product = product_sales(lines, products, users, dedupe_dims=dedupe_dims, places=places)
    per_buyer = buyer_sales(lines, products, users, dedupe_dims=dedupe_dims, places=places)
    with publish.materialised(per_product, per_buyer):
        sales = {"product": per_product, "buyer": per_buyer}
        publish.publish(spark, base, [run_date], lambda m, folder: publish.stage_day(m, sales[m.source], folder, run_date, places))
    publish.check_day(spark, base, run_date)
    load_warehouse(spark, base, run_date, run_date, by_content)


Week = tuple[int, int]


def _week(values: Mapping[str, str]) -> Week:
    return int(values["iso_year"]), int(values["iso_week"])


def _weeks(spark: SparkSession, base: str, kind: str, days: Iterable[date]) -> DataFrame:
    """Snapshots of the ISO weeks of ``days``, each of which has to be there; other partitions are not listed."""
    path, wanted = zones.zone(base, "raw", kind), {day.isocalendar()[:2] for day in days}
    missing = wanted - {_week(values) for _, values in zones.partitions(spark, path, keys=2)}
    if missing:
        raise MissingSnapshot(f"no {kind} snapshot for ISO week {'/'.join(map(str, min(missing)))}")
    return zones.read_table(spark, path, only=lambda values: _week(values) in wanted, keys=2)


def _marks(spark: SparkSession, base: str, first: date, last: date, *options: object) -> dict[date, str]:
    """What each landed day of a range would be computed from: the landing of its carts, the content of its week's snapshots, and the options.

    The content of a snapshot is the sum of its rows' hashes and their number, in one pass over the snapshots of the range's weeks.
    """
    landed, prints = landing.landings(spark, base, first, last), {}
    for kind in ("products", "users"):
        rows = _weeks(spark, base, kind, landed) if landed else None
        fields = [] if rows is None else sorted(c for c in rows.columns if c not in WEEK_KEY)
        if rows is not None:
            found = rows.groupBy(*WEEK_KEY).agg(F.sum(F.xxhash64(*fields).cast("decimal(20,0)")).alias("hash"), F.count(F.lit(1)).alias("n"))
            # A row for each week.
            prints[kind] = {(r.iso_year, r.iso_week): f"{r.n}:{r.hash}" for r in found.collect()}
    said = "|".join(map(str, options))
    return {day: "|".join([folder, *(prints[kind].get(day.isocalendar()[:2], "0") for kind in ("products", "users")), said]) for day, folder in landed.items()}


def run_history(
    spark: SparkSession,
    base: str,
    first: date,
    last: date,
    buyer_col: str = "id",
    dedupe_dims: bool = False,
    by_content: bool = False,
) -> None:
    """Metrics of every landed day from ``first`` to ``last`` in one go.

    Each day meets the snapshots of its own ISO week. The days come from the log of the
    landed snapshots. The rollups are written to the shared scratch folder, so the carts are
    read once for each of them however many metrics there are (and once more for hot keys
    where prices are too large to broadcast), and a lost executor costs no rework of the fact.
    A landed day without any sale becomes empty in every table, as in ``run_day``.
    """
    _run(spark, base, landing.landed_days(spark, base, first, last), first, last, buyer_col, dedupe_dims, by_content)


def run_changes(
    spark: SparkSession, base: str, first: date, last: date, buyer_col: str = "id", dedupe_dims: bool = False, by_content: bool = False
) -> list[date]:
    """What ``run_history`` gives, computing only the days that something changed for; returns these days.

    A day has changed if it is not published, if its carts were landed anew, if the snapshot of its week has other rows,
    or if it was published with other options. Only the carts of those days and the snapshots
    of their weeks are read (and, for the comparison, the snapshots of the range).
    """
    marks, known = _marks(spark, base, first, last, buyer_col, dedupe_dims), publish.published_marks(spark, base, first, last)
    days = sorted(day for day, mark in marks.items() if known.get(day) != mark)
    if days:
        _run(spark, base, days, first, last, buyer_col, dedupe_dims, by_content, {day: marks[day] for day in days})
    return days


def _run(
    spark: SparkSession, base: str, days: list[date], first: date, last: date, buyer_col: str, dedupe_dims: bool, by_content: bool, marks: Mapping[date, str] | None = None
) -> None:
    carts = landing.read_carts(spark, base, first, last, days)
    products = flatten_products(_weeks(spark, base, "products", days), keep=WEEK_KEY)
    users = flatten_users(_weeks(spark, base, "users", days), keep=WEEK_KEY)

    lines, places = sale_lines(carts, buyer_col, by=DAY), money.places_needed(products)
    options = {"by": DAY, "weekly": True, "dedupe_dims": dedupe_dims, "places": places}
    with settled(spark) as keep:
        sales = {
            "product": keep(product_sales(lines, products, users, **options), "product_sales"),
            "buyer": keep(buyer_sales(lines, products, users, keep=keep, **options), "buyer_sales"),
        }
        publish.publish(spark, base, days, lambda m, folder: publish.stage_days(m, sales[m.source], folder, days, places), marks=marks)
    publish.check_days(spark, base, days)
    load_warehouse(spark, base, first, last, by_content, days)
