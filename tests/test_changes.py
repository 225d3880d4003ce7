"""Derived tables take in exactly what changed: month cubes after corrections, reports after late records."""

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_audience import stays

from daybook.functions.dates import date_key
from daybook.functions.presets import fixture_packages
from daybook.plans import audience, exposure, jobs, sales
from daybook.sources import changes, commits, tables

D0 = dt.date(2024, 3, 2)
ORDER = "package_id string, order_provide string, order_price long, order_type int, order_status int, order_state int, order_delevetime long"
DERIVED = ("c_fact", "c_cube", "c_stays", "c_aud", "c_aud_codes", "c_rep")


@pytest.fixture(autouse=True)
def clean(spark):
    drop = lambda: [spark.sql(f"DROP TABLE IF EXISTS {t}{s}") for t in DERIVED for s in ("", "_changes", "_applied")]
    drop()
    yield
    drop()


def orders(spark, seed, days, n=120):
    rng = random.Random(seed)
    ms = lambda d: int(dt.datetime(d.year, d.month, d.day, tzinfo=dt.timezone.utc).timestamp() * 1000)
    return spark.createDataFrame([(f"PK{rng.randrange(24)}", rng.choice(["iQIYI", "Youku"]), rng.randrange(9999), rng.randrange(1, 4), 4, 1,
                                   ms(rng.choice(days)) + rng.randrange(86_400_000)) for _ in range(n)], ORDER)


def full_cube(spark):
    return rows(sales.monthly_sales_cube(tables.read_daily_fact(spark, "c_fact")))


def cube(spark):
    want = sales.monthly_sales_cube(tables.read_daily_fact(spark, "c_fact")).columns
    return rows(spark.table("c_cube").select(*want))


def test_month_cube_follows_corrections(spark):
    days = [dt.date(2024, 1, 31), dt.date(2024, 2, 1), dt.date(2024, 2, 29), dt.date(2024, 3, 1), D0]
    run = lambda frame, of: jobs.update_monthly_sales(spark, frame, "c_fact", "c_cube", of, preset=fixture_packages())
    first = orders(spark, 1, days)
    assert run(first, days[:4]) == ["202401", "202402", "202403"]
    assert cube(spark) == full_cube(spark) != []
    assert run(first, [D0]) == ["202403"] and cube(spark) == full_cube(spark)
    # a late correction of a day of February, and one that empties January
    late = first.union(orders(spark, 2, [days[2]], 30))
    folders = {p: f for p, f in zip("123", commits.live_folders(spark, "c_cube"), strict=True)}
    assert run(late, [days[2]]) == ["202402"] and cube(spark) == full_cube(spark)
    after = commits.live_folders(spark, "c_cube")
    assert folders["1"] in after and folders["3"] in after and folders["2"] not in after
    assert run(late.where(F.col("order_delevetime") > 1_706_745_600_000), [days[0]]) == ["202401"]
    assert cube(spark) == full_cube(spark) and "202401" not in {r[0] for r in cube(spark)}
    assert jobs.refresh_monthly_sales(spark, "c_fact", "c_cube") == []


def test_refresh_reads_the_touched_months_only(spark):
    days = [dt.date(2024, 1, 31), dt.date(2024, 2, 1), D0]
    tables.store_daily_fact(sales.daily_order_fact(orders(spark, 3, days), None, preset=fixture_packages()), "c_fact")
    part = sales.cube_of_months(tables.read_daily_fact(spark, "c_fact"), ["202402"])
    files = part.inputFiles()
    assert files and all("date=202402" in f for f in files)
    assert rows(part.select("month").distinct()) == [("202402",)]


def test_a_commit_that_died_stays_pending_until_it_is_rerun(spark, monkeypatch):
    days = [dt.date(2024, 2, 1), D0]
    first = orders(spark, 1, days)
    update = lambda frame, of: jobs.update_monthly_sales(spark, frame, "c_fact", "c_cube", of, preset=fixture_packages())
    update(first, days)
    sql = spark.sql

    def dying(text, *args, **kw):
        if "SET LOCATION" in text:
            sql(text, *args, **kw)
            raise RuntimeError("driver lost")        # the partition is turned, its end never noted
        return sql(text, *args, **kw)
    monkeypatch.setattr(spark, "sql", dying)
    more = first.union(orders(spark, 5, [D0], 40))
    with pytest.raises(RuntimeError):
        update(more, [D0])
    monkeypatch.undo()
    spark.catalog.refreshTable("c_fact")
    for _ in range(2):
        assert jobs.refresh_monthly_sales(spark, "c_fact", "c_cube") == ["202403"]
        assert cube(spark) == full_cube(spark)
    update(more, [D0])
    assert cube(spark) == full_cube(spark)


def test_late_records_rebuild_exactly_the_affected_reports(spark):
    days = [D0 - dt.timedelta(days=k) for k in range(5)]

    def load(seed, day, of, n=60):
        tables.store_page_stay(stays(spark, seed, n, of), "c_stays", day, fmt="parquet")
        audience.update_audience(spark, "c_stays", "c_aud", day)
    for day in reversed(days):
        load(day.day, day, [day])
        if day >= days[3]:
            assert audience.refresh_exposures(spark, "c_aud", "c_rep", day) == [day]
    read = lambda: {d: rows(spark.table("c_rep").where(F.col("date") == date_key(d))) for d in days[:4]}
    before = read()
    assert audience.refresh_exposures(spark, "c_aud", "c_rep") == []
    # a load with late records of one day: its report, the next day's and the one a week later, where stored
    late_day = days[3]
    load(99, D0 + dt.timedelta(days=1), [late_day, D0 + dt.timedelta(days=1)], 200)
    assert audience.affected_reports([late_day]) == [late_day, days[2], late_day + dt.timedelta(days=7)]
    assert audience.refresh_exposures(spark, "c_aud", "c_rep") == [late_day, days[2]]
    after = read()
    raw = tables.read_page_stay(spark, "c_stays")
    for d in days[:4]:
        want = exposure.page_exposure_report(raw, d)
        assert rows(spark.table("c_rep").where(F.col("date") == date_key(d)).select(*want.columns)) == rows(want)
        assert (after[d] != before[d]) == (d in (late_day, days[2]))
    # the load is run again without the late day: that day changes back
    load(98, D0 + dt.timedelta(days=1), [D0 + dt.timedelta(days=1)])
    assert audience.refresh_exposures(spark, "c_aud", "c_rep") == [late_day, days[2]]
    assert read()[late_day] == before[late_day]


def test_pending_without_commits(spark):
    assert changes.pending(spark, "c_fact", "c_cube") == changes.Pending([], [])
    commits.commit_partitions(spark.createDataFrame([("20240101", 1)], "date string, v int"), "c_fact", ["date"], track="date")
    todo = changes.pending(spark, "c_fact", "c_cube")
    assert todo.days == ["20240101"] and len(todo.runs) == 1
    changes.taken_in(spark, "c_fact", "c_cube", todo.runs)
    assert changes.pending(spark, "c_fact", "c_cube") == changes.Pending([], [])
    assert changes.pending(spark, "c_fact", "c_rep") == todo
