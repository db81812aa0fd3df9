"""Commits: all or nothing, one writer for each number, readers that see only what is committed."""

import threading
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tallyroll.plans import publish, warehouse
from tallyroll.plans.metrics import METRICS
from tallyroll.sources import buckets, versions

DAY = date(2025, 4, 14)
METRIC = METRICS["num_of_prod_sold"]


def daily(spark, *values):
    return spark.createDataFrame([(d, p, n) for d, p, n in values], "run_date date, product_ID long, Num_prod_sold long")


def keys(table):
    return sorted(r.date_id for r in table.collect())


def test_each_number_is_published_once(spark, tmp_path):
    base = str(tmp_path / "t")
    with ThreadPoolExecutor(8) as pool:
        done = list(pool.map(lambda i: versions.commit(spark, base, f"run={i}", [f"2025-01-{i + 1:02d}"], {"t": {"f": i}}), range(12)))
    found = versions.log(spark, base)
    assert all(done) and [c.number for c in found] == list(range(1, 13))
    assert {c.folder for c in found} == {f"run={i}" for i in range(12)}
    assert {c.folder: c.files["t"]["f"] for c in found} == {f"run={i}": i for i in range(12)}
    assert versions.log(spark, str(tmp_path / "none")) == []


def test_a_clash_is_reported_and_nothing_published(spark, tmp_path):
    base = str(tmp_path)
    seen = versions.log(spark, base)
    assert versions.commit(spark, base, "run=a", ["2025-01-01"], {}, seen)
    assert not versions.commit(spark, base, "run=b", ["2025-01-01"], {}, seen, lambda other: "2025-01-01" in other.days)
    assert versions.commit(spark, base, "run=c", ["2025-01-02"], {}, seen, lambda other: "2025-01-02" in other.days)
    assert [c.folder for c in versions.log(spark, base)] == ["run=a", "run=c"]


def test_ranges_of_kept_days():
    commit = versions.Commit(1, "run=a", ("1", "2", "4", "7", "9"), {})
    assert versions.runs_of(commit, ["2", "4", "9"]) == [("2", "4"), ("9", "9")]
    assert versions.runs_of(commit, []) == [] and versions.runs_of(commit, commit.days) == [("1", "9")]


@pytest.mark.parametrize("by_content", [False, True])
def test_two_loads_of_one_day_at_once(spark, tmp_path, monkeypatch, by_content):
    """Both stage the same keys before either commits; each key is stored once."""
    path, barrier, plain, first = str(tmp_path / "t"), threading.Barrier(2, timeout=120), versions.commit, threading.local()

    def together(*args, **options):
        if not getattr(first, "done", False):
            first.done = True
            barrier.wait()
        return plain(*args, **options)

    monkeypatch.setattr(versions, "commit", together)
    rows = daily(spark, (DAY, 1, 9), (DAY, 2, 8), (DAY, 3, 7))

    def load(table):
        keyed = warehouse.content_rows(table) if by_content else warehouse.position_rows(METRIC, table)
        warehouse.load(keyed, path, DAY, DAY, by_content)
        return keyed

    with ThreadPoolExecutor(2) as pool:
        keyed = list(pool.map(load, [rows, rows.unionByName(daily(spark, (DAY, 4, 6)))]))
    stored = keys(warehouse.read_stored(keyed[0], path))
    assert len(stored) == len(set(stored)) == 4
    assert len(versions.log(spark, path)) in (1, 2)
    # What was staged in vain is gone.
    assert len(list((tmp_path / "t").glob("run=*"))) == len(versions.log(spark, path))


def test_loads_of_different_days_both_go_through(spark, tmp_path):
    path, days = str(tmp_path / "t"), [DAY + timedelta(days=n) for n in range(4)]
    keyed = [warehouse.position_rows(METRIC, daily(spark, (d, 1, 5), (d, 2, 4))) for d in days]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: warehouse.load(keyed[i], path, days[i], days[i], False), range(4)))
    assert keys(warehouse.read_stored(keyed[0], path)) == sorted(f"{d}_{n}" for d in days for n in (1, 2))
    assert keys(warehouse.read_stored(keyed[0], path, days[1], days[2])) == sorted(f"{d}_{n}" for d in days[1:3] for n in (1, 2))


def test_a_load_that_dies_before_its_commit_leaves_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    keyed = warehouse.position_rows(METRIC, daily(spark, (DAY, 1, 9), (DAY, 2, 8)))

    class Killed(BaseException):
        pass

    def killed(*args, **options):
        raise Killed

    with monkeypatch.context() as patch:
        # As a killed driver: it neither commits nor cleans up.
        patch.setattr(versions, "commit", killed)
        patch.setattr(warehouse, "remove", lambda *a: None)
        with pytest.raises(Killed):
            warehouse.load(keyed, path, DAY, DAY, False)
    assert len(list((tmp_path / "t").glob("run=*"))) == 1
    assert warehouse.read_stored(keyed, path).count() == 0
    warehouse.load(keyed, path, DAY, DAY, False)
    assert keys(warehouse.read_stored(keyed, path)) == [f"{DAY}_1", f"{DAY}_2"]
    assert versions.clear(spark, path) == [] and len(versions.clear(spark, path, older_than_hours=0)) == 1
    assert keys(warehouse.read_stored(keyed, path)) == [f"{DAY}_1", f"{DAY}_2"]


def test_a_run_that_fails_at_the_seventh_table_changes_none(spark, tmp_path):
    base, names = str(tmp_path), list(METRICS)

    def stage(value, failing=None, days=(DAY, DAY + timedelta(days=1))):
        def write(metric, folder):
            if metric.name == failing:
                raise RuntimeError(failing)
            path = f"{folder}/{metric.name}"
            spark.createDataFrame([(d, value) for d in days], "run_date date, v long").write.parquet(path)
            return versions.files(spark, path)

        return write

    days = [DAY, DAY + timedelta(days=1)]
    publish.publish(spark, base, days, stage(1))
    with pytest.raises(RuntimeError, match=names[6]):
        publish.publish(spark, base, days, stage(2, names[6]))
    assert len(list((tmp_path / "analytics").glob("run=*"))) == 1
    publish.check_days(spark, base, days)
    for name in names:
        assert [r.v for r in publish.read_published(spark, base, name, *days).collect()] == [1, 1]
    # One of the two days anew: the other one stays with its run.
    publish.publish(spark, base, days[:1], stage(3, days=days[:1]))
    for name in (names[0], names[11]):
        assert sorted((r.run_date, r.v) for r in publish.read_published(spark, base, name, *days).collect()) == [(days[0], 3), (days[1], 1)]
        rows = {(r.run_date, r.v) for r in publish.read_published(spark, base, name, days[1], days[1]).collect()}
        assert rows == {(days[1], 1)}


def test_a_few_days_of_a_run_skip_the_other_files(spark, tmp_path):
    base, days = str(tmp_path), [DAY + timedelta(days=n) for n in range(40)]
    sales = spark.createDataFrame([(d, p, p) for d in days for p in range(50)], "run_date date, product_ID long, lines long")
    publish.publish(spark, base, days, lambda m, folder: publish.stage_days(m, sales, folder, days), [METRIC])
    table = publish.read_published(spark, base, METRIC.name, days[3], days[4])
    assert table.count() == 100 and table.agg(F.min("run_date"), F.max("run_date")).first() == (days[3], days[4])
    assert "GreaterThanOrEqual(run_date,2025-04-17)" in table._jdf.queryExecution().executedPlan().toString()
    assert len({r.f for r in table.select(F.col("_metadata.file_name").alias("f")).collect()}) <= 2


def test_a_table_in_buckets_is_not_shuffled_by_a_load(spark, tmp_path):
    # As if the stored keys were too large for Spark to broadcast by itself.
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _loads_in_buckets(spark, tmp_path)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _loads_in_buckets(spark, tmp_path):
    path, days, last = str(tmp_path / "t"), [DAY + timedelta(days=n) for n in range(6)], DAY + timedelta(days=5)
    first = warehouse.content_rows(daily(spark, *((d, p, p) for d in days for p in range(200))))
    more = warehouse.content_rows(daily(spark, *((d, p, p) for d in days for p in range(100, 260))))
    third = warehouse.content_rows(daily(spark, *((d, p, p) for d in days[:2] for p in range(300))))
    warehouse.load(first, path, DAY, last, buckets=4, small_bytes=0)
    warehouse.load(more, path, DAY, last, buckets=4, small_bytes=0)
    commits = versions.log(spark, path)
    assert [c.buckets for c in commits] == [4, 4] and [len(c.files[""]) for c in commits] == [4, 4]
    assert spark.read.parquet(f"{path}/{commits[1].folder}").count() == 6 * 60
    stored = warehouse.in_buckets(commits, DAY, last, 4, 0)
    with buckets.opened(spark, [f"{path}/{c.folder}" for c in stored], warehouse.KEY_COLUMNS, "date_id", 4) as tables:
        fresh = warehouse.fresh_keys(third, path, commits, DAY, last, 4, tables, 0)
        text = fresh._jdf.queryExecution().executedPlan().toString()
        # One shuffle, that of the new rows.
        assert text.count("Exchange") == 1 and "Exchange hashpartitioning(date_id" in text and text.count("Bucketed: true") == 2
        assert text.count("GreaterThanOrEqual(static_date,") == 2
        assert fresh.count() == 2 * 40
    assert spark.catalog.listTables() == []
    warehouse.load(third, path, DAY, last, buckets=4, small_bytes=0)
    warehouse.load(third, path, DAY, last, buckets=4, small_bytes=0)
    assert len(versions.log(spark, path)) == 3
    found = keys(warehouse.read_stored(first, path))
    assert len(found) == len(set(found)) == 2 * 300 + 4 * 260


@pytest.mark.parametrize("small_bytes", [0, 1 << 20])
def test_loads_in_other_buckets_or_none_are_found(spark, tmp_path, small_bytes):
    path, last = str(tmp_path / "t"), DAY + timedelta(days=1)
    for step, n in enumerate((0, 4, 8, 8, 0, 4)):
        rows = warehouse.position_rows(METRIC, daily(spark, *((d, p, -p) for d in (DAY, last) for p in range(10 * (step + 1)))))
        warehouse.load(rows, path, DAY, last, False, buckets=n, small_bytes=small_bytes)
        found = keys(warehouse.read_stored(rows, path))
        assert len(found) == len(set(found)) == 20 * (step + 1)
    assert [c.buckets for c in versions.log(spark, path)] == [0, 4, 8, 8, 0, 4]
    before = len(versions.log(spark, path))
    warehouse.load(rows.limit(0), path, DAY, last, False, buckets=4)
    assert len(versions.log(spark, path)) == before and len(list((tmp_path / "t").glob("run=*"))) == before


def test_other_rows_than_those_written_are_named(spark, tmp_path):
    base, days = str(tmp_path), [DAY, DAY + timedelta(days=1), DAY + timedelta(days=2)]

    def sales(*days):
        return spark.createDataFrame([(d, p, 3 * p) for d in days for p in range(20)], "run_date date, product_ID long, lines long")

    publish.publish(spark, base, days[:2], lambda m, folder: publish.stage_days(m, sales(*days[:2]), folder, days[:2]), [METRIC])
    publish.publish(spark, base, days[2:], lambda m, folder: publish.stage_days(m, sales(DAY).where("product_ID < 0"), folder, days[2:]), [METRIC])
    found = {r.table_name + r.folder: r for r in publish.contents(spark, base, days).collect()}
    assert sorted(r.found.split(":")[0] for r in found.values()) == ["0", "40"] and all(r.written == r.found for r in found.values())
    folder = versions.log(spark, str(tmp_path / "analytics"))[0].folder
    path = f"{base}/analytics/{folder}/{METRIC.name}"
    table = spark.read.parquet(path)
    rows, schema = table.collect(), table.schema
    commit = versions.log(spark, str(tmp_path / "analytics"))[0]
    assert commit.contents[METRIC.name].split(":")[0] == "40"
    # Two values change places, a row is twice there, a row is gone.
    other = [r.asDict() for r in rows]
    other[0]["Num_prod_sold"], other[1]["Num_prod_sold"] = other[1]["Num_prod_sold"], other[0]["Num_prod_sold"]
    for changed, n in ((other, 40), ([*rows, rows[0]], 41), (rows[1:], 39)):
        spark.createDataFrame(changed, schema).write.mode("overwrite").parquet(path)
        (found,) = publish.contents(spark, base, days[:1]).collect()
        assert found.written != found.found and found.found.startswith(f"{n}:")
    with pytest.raises(publish.MissingOutput):
        publish.check_contents(spark, base, days[:1])
    with pytest.raises(publish.MissingOutput):
        publish.contents(spark, base, [DAY - timedelta(days=9)])


def test_changed_values_in_files_of_the_same_length(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    sales = spark.createDataFrame([(DAY, p, 3 * p) for p in range(20)], "run_date date, product_ID long, lines long")
    publish.publish(spark, base, [DAY], lambda m, folder: publish.stage_days(m, sales, folder, [DAY]), [METRIC])
    monkeypatch.setattr(publish, "METRICS", {METRIC.name: METRIC})
    publish.check_contents(spark, base, [DAY])
    path = f"{base}/analytics/{versions.log(spark, base + '/analytics')[0].folder}/{METRIC.name}"
    table = spark.read.parquet(path)
    changed = spark.createDataFrame([r.asDict() | {"Num_prod_sold": 7} for r in table.collect()], table.schema)
    changed.write.mode("overwrite").parquet(path)
    monkeypatch.setattr(publish, "check_days", lambda *a: None)
    with pytest.raises(publish.ChangedOutput, match=f"{METRIC.name}: run=.* with other values"):
        publish.check_contents(spark, base, [DAY])


def test_many_ranges_are_few_conditions(spark, tmp_path):
    days = [DAY + timedelta(days=n) for n in range(400)]
    daily(spark, *((d, 1, n) for n, d in enumerate(days))).write.parquet(f"{tmp_path}/run=a")
    versions.commit(spark, str(tmp_path), "run=a", [d.isoformat() for d in days], {})
    for step in (3, 90):
        wanted = [d for n, d in enumerate(days) if n % step in (0, 1)]
        found = versions.read(spark, str(tmp_path), only=wanted)
        assert sorted(r.run_date for r in found.collect()) == wanted
        assert found._jdf.queryExecution().optimizedPlan().toString().count(">=") <= versions.MOST_RANGES


def test_keyed_rows_are_shuffled_without_their_key(spark, tmp_path):
    rows = daily(spark, *((DAY + timedelta(days=n % 7), n % 50, n) for n in range(300)), (DAY, None, 1), (DAY, 3, None), (DAY, 3, None))
    dealt = warehouse.content_rows(rows, 5)
    assert sorted(map(str, dealt.collect())) == sorted(map(str, warehouse.content_rows(rows).collect()))
    plan = dealt.repartition(5, "date_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    last, path = DAY + timedelta(days=6), str(tmp_path / "w")
    for part in (rows.where("product_ID < 20"), rows, rows):
        warehouse.load(warehouse.content_rows(part, 5), path, DAY, last, buckets=5, small_bytes=0)
    stored = warehouse.read_stored(dealt, path)
    assert set(keys(stored)) == set(keys(dealt)) and stored.count() == rows.count()
