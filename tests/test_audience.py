"""Stored audiences: exact distinct users from merged bitmaps, with late loads, reruns and large dictionaries."""

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from daybook.functions.dates import iso
from daybook.operators.distinct import bitmap_rows, empty_codes, merged_counts, new_codes
from daybook.plans import audience, exposure
from daybook.sources import tables

D0 = dt.date(2024, 3, 1)
STAY = "custom_uuid string, account string, date date, site string, vercode string, vername string, device_name string, " \
       "enter timestamp_ntz, exit timestamp_ntz, staySeconds long, title string, dt string"


def stays(spark, seed, n, days, users=60):
    """Random stays: a hot user, unknown users, NULL titles, stays that are too long, negative or unknown."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        user = "hot" if rng.random() < .34 else None if rng.random() < .1 else f"u{rng.randrange(users)}"
        seconds = rng.choice([None, -5, 0, 10, 300, 10 ** 7, rng.randrange(4000)])
        out.append((user, "a", None, rng.choice(["iqiyi", "youku", None]), "1", "v", "d", None, None, seconds,
                    rng.choice(["t1", "t2", None]), iso(rng.choice(days))))
    return spark.createDataFrame(out, STAY)


@pytest.fixture
def names(spark, tmp_path):
    drop = lambda: [spark.sql(f"DROP TABLE IF EXISTS {t}") for t in ("aud", "aud_codes")]
    drop()
    yield str(tmp_path / "stays"), "aud"
    drop()


def test_loads_late_records_and_reruns_equal_the_raw_cube(spark, names):
    path, name = names
    days = [D0 - dt.timedelta(days=k) for k in range(3)]
    for k, load in enumerate(reversed(days)):
        # each load holds its own day and late records of the days before
        tables.store_page_stay(stays(spark, k, 400, [d for d in days if d <= load]), path, load)
        audience.update_audience(spark, path, name, load)
    raw = tables.read_page_stay(spark, path)
    stored = spark.table(name)
    assert rows(audience.exposure_cube(stored, days)) == rows(exposure.exposure_cube(raw, days)) != []
    codes = rows(spark.table("aud_codes").select("custom_uuid", "code"))
    # a rerun of a load with other rows, some users gone and some new, twice
    tables.store_page_stay(stays(spark, 9, 300, days[1:], users=90), path, days[1])
    for _ in range(2):
        audience.update_audience(spark, path, name, days[1])
    assert rows(audience.exposure_cube(spark.table(name), days)) == rows(exposure.exposure_cube(tables.read_page_stay(spark, path), days))
    later = rows(spark.table("aud_codes").select("custom_uuid", "code"))
    assert set(codes) < set(later) and len({c for _, c in later}) == len(later) == len({u for u, _ in later})
    report = audience.exposure_report(spark.table(name), D0)
    assert rows(report) == rows(exposure.page_exposure_report(tables.read_page_stay(spark, path), D0)) != []


def test_periods_count_a_user_once(spark, names):
    path, name = names
    days = [D0 - dt.timedelta(days=k) for k in range(14)]
    tables.store_page_stay(stays(spark, 4, 1500, days), path, D0)
    audience.update_audience(spark, path, name, D0)
    periods = {"w0": audience.week(D0), "w1": audience.week(days[7]), "both": days, "overlap": days[3:9]}
    got = {(r.period, r.site, r.title, r.id_1): (r.users, r.playNum) for r in audience.period_cube(spark.table(name), periods).collect()}
    limit = exposure.MAX_STAY_SECONDS
    raw = tables.read_page_stay(spark, path).where(F.col("staySeconds").between(0, limit))
    for period, of in periods.items():
        part = raw.where(F.col("dt").isin([iso(d) for d in of]))
        for r in part.cube("site", "title").agg(F.grouping_id().alias("g"), F.count_distinct("custom_uuid").alias("n"),
                                                F.count("custom_uuid").alias("p")).collect():
            assert got.pop((period, r.site, r.title, r.g)) == (r.n, r.p)
    assert not got


def test_a_failed_run_leaves_the_audience(spark, names, monkeypatch):
    path, name = names
    tables.store_page_stay(stays(spark, 1, 200, [D0]), path, D0)
    audience.update_audience(spark, path, name, D0)
    before = rows(audience.exposure_cube(spark.table(name), [D0]))
    tables.store_page_stay(stays(spark, 2, 200, [D0], users=200), path, D0)
    real = audience.audience_rows
    broken = lambda *a: real(*a).withColumn("plays", F.raise_error(F.lit("lost")).cast("long"))
    monkeypatch.setattr(audience, "audience_rows", broken)
    with pytest.raises(Exception, match="lost"):
        audience.update_audience(spark, path, name, D0)
    assert rows(audience.exposure_cube(spark.table(name), [D0])) == before
    monkeypatch.undo()
    audience.update_audience(spark, path, name, D0)
    assert rows(audience.exposure_cube(spark.table(name), [D0])) == rows(exposure.exposure_cube(tables.read_page_stay(spark, path), [D0]))


def test_the_report_reads_no_user(spark, names):
    path, name = names
    tables.store_page_stay(stays(spark, 1, 200, [D0]), path, D0)
    audience.update_audience(spark, path, name, D0)
    plan = audience.exposure_report(spark.table(name), D0)._jdf.queryExecution().executedPlan().toString()
    assert "custom_uuid" not in plan and "PartitionFilters: [dt" in plan.replace("isnotnull(dt#", "dt#").replace("[dt#", "[dt")


def test_codes_over_many_buckets_and_lanes(spark):
    """Codes far apart fall into many buckets; every group still counts its values exactly, in any merge."""
    df = spark.range(3000).selectExpr("concat('v', id % 700) AS value", "id % 5 AS part", "CAST(id AS long) AS n").union(
        spark.createDataFrame([(None, 1, 7), (None, 9, 8)], "value string, part long, n long"))
    codes = new_codes(df.where("part < 3"), "value", empty_codes(df, "value"), lanes=70_000)
    codes = codes.union(new_codes(df, "value", codes, lanes=70_000))
    got = codes.agg(F.count("*").alias("n"), F.count_distinct("code").alias("codes"), F.max("code").alias("top"),
                    F.min("code").alias("low")).first()
    assert got.n == got.codes == 700 and got.low >= 1 and got.top > 2 * 32768
    single = df.groupBy("part", "value").agg(F.sum("n").alias("n"))
    stored = bitmap_rows(single, ["part"], "value", codes, {"n": F.col("n")})
    assert stored.select("bucket").distinct().count() > 2
    merged = merged_counts(stored, ["part"], ["n"])
    want = df.cube("part").agg(F.grouping_id().alias("id_1"), F.count_distinct("value").alias("users"), F.sum("n").alias("n"))
    assert rows(merged.select("part", "id_1", "users", "n")) == rows(want)


def test_no_values(spark):
    none = stays(spark, 1, 0, [D0])
    codes = new_codes(none, "custom_uuid", empty_codes(none, "custom_uuid"))
    assert rows(codes) == [] and rows(audience.exposure_cube(audience.audience_rows(none, codes), [D0])) == []
