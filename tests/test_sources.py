"""Sources and sinks on fresh temporary folders."""

import datetime as dt
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from daybook.functions.dates import day_bounds_ms, iso, report_days
from daybook.functions.presets import fixture_packages
from daybook.plans import catalog, exposure, heatmap, jobs, sales
from daybook.sources import fixtures as fx
from daybook.sources import jdbc, logs, tables
from daybook.sources.schemas import PAGE_STAY
from daybook.streaming.ingest import page_stay_stream

SMALL = "/root/testdata/sf0.001"
D0 = fx.EVENTS_DAY


def write_log_days(spark, root, days):
    """Fixture log records as gzip JSON lines under {root}/{day}/h00/part-*.json.gz."""
    src = fx.launcher_logs(spark, SMALL)
    day = F.to_date(F.timestamp_millis("rectime")).cast("string")
    for d in days:
        (src.where(day == iso(d)).coalesce(2).write.option("compression", "gzip")
         .json(os.path.join(root, iso(d), "h00")))


def write_raw(root, day, name, records):
    folder = os.path.join(root, iso(day), "h99")
    os.makedirs(folder, exist_ok=True)
    with gzip.open(os.path.join(folder, name), "wt") as fh:
        for r in records:
            fh.write(json.dumps(r) + "\n")


@pytest.fixture(scope="module")
def log_root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("logs"))
    write_log_days(spark, root, report_days(D0).values())
    return root


def test_read_logs_with_folder_day(spark, log_root):
    days = list(report_days(D0).values())
    df = logs.read_logs(spark, log_root, days)
    got = {r.log_day: r.n for r in df.groupBy("log_day").agg(F.count("*").alias("n")).collect()}
    assert set(got) == {iso(d) for d in days}
    want = fx.launcher_logs(spark, SMALL, days).count()
    assert sum(got.values()) == want
    assert "FileScan json" in df._jdf.queryExecution().executedPlan().toString()


def test_require_inputs_names_missing_days(spark, log_root):
    with pytest.raises(logs.MissingInputError, match="2024-01-01"):
        logs.read_logs(spark, log_root, [dt.date(2024, 1, 1), D0])


def test_absent_field_reads_as_null(spark, tmp_path):
    root = str(tmp_path)
    write_raw(root, D0, "a.gz", [{"custom_uuid": "u1", "site": "ALI", "rectime": day_bounds_ms(D0)[0],
                                  "data": {"home_item_click": [{"time": 1, "position": "1,1", "title": "t"}]}}])
    df = logs.read_logs(spark, root, [D0])
    clicks = heatmap.click_rows(df, day_col="log_day", missing_category="null")
    assert [(r.site, r.category, r.position, r.dt) for r in clicks.collect()] == [
        ("youku", "null", "1,1", iso(D0))]


def test_heatmap_job_equals_direct_report(spark, log_root):
    got = jobs.heatmap_job(spark, log_root, D0, min_count=fx.FIXTURE_MIN_GROUP,
                           title_min_count=fx.FIXTURE_MIN_TITLE)
    want = catalog.click_heatmap_report(spark, SMALL)
    assert got.columns == want.columns
    assert rows(got) == rows(want)
    assert got.count() > 0


def test_page_stay_store_is_rerun_safe_and_keeps_late_rows(spark, log_root, tmp_path):
    table = str(tmp_path / "page_stay")
    d0, d1, d7 = report_days(D0).values()
    for d in (d7, d1, d0):
        jobs.ingest_page_stay(spark, log_root, table, d)
    base = tables.read_page_stay(spark, table).count()
    jobs.ingest_page_stay(spark, log_root, table, d0)            # rerun: replaced, not appended
    assert tables.read_page_stay(spark, table).count() == base
    # a late record of day-1 arriving in a later day's folder lands in dt=day-1
    late_root = str(tmp_path / "late")
    record = {"custom_uuid": "late", "site": "ALI", "rectime": day_bounds_ms(d1)[0] + 5,
              "data": {"launcher_page_stay": [{"time": 1, "enter": 1, "exit": 2}]}}
    write_raw(late_root, dt.date(2024, 2, 1), "late.gz", [record])
    jobs.ingest_page_stay(spark, late_root, table, dt.date(2024, 2, 1))
    jobs.ingest_page_stay(spark, log_root, table, d1)            # rerun of day-1: late row survives
    late = tables.read_page_stay(spark, table, [d1]).where(F.col("custom_uuid") == "late")
    assert [r.dt for r in late.collect()] == [iso(d1)]
    assert tables.read_page_stay(spark, table).count() == base + 1


def test_page_exposure_job_reads_pruned_partitions(spark, log_root, tmp_path):
    table = str(tmp_path / "page_stay")
    d0, d1, d7 = report_days(D0).values()
    for d in (d7, d1):
        jobs.ingest_page_stay(spark, log_root, table, d)
    got = jobs.page_exposure_job(spark, log_root, table, d0)
    want = catalog.page_exposure_report(spark, SMALL)
    assert rows(got) == rows(want)
    plan = tables.read_page_stay(spark, table, [d0])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "2024-01-30" in plan


def test_monthly_job_rerun_does_not_double_count(spark, tmp_path):
    fact_path = str(tmp_path / "fact")
    orders = fx.sales_orders(spark, SMALL)
    preset = fixture_packages()
    first = rows(jobs.monthly_sales_job(spark, orders, fact_path, D0, preset=preset))
    again = rows(jobs.monthly_sales_job(spark, orders, fact_path, D0, preset=preset))
    assert first == again
    want = sales.monthly_sales_cube(sales.daily_order_fact(orders, D0, preset=preset))
    assert first == rows(want)
    jobs.monthly_sales_job(spark, orders, fact_path, D0 - dt.timedelta(days=1), preset=preset)
    both = sales.daily_order_fact(orders.where(F.col("order_delevetime") >= day_bounds_ms(D0 - dt.timedelta(days=1))[0])
                                  .where(F.col("order_delevetime") < day_bounds_ms(D0)[1]), None, preset=preset)
    assert rows(tables.read_daily_fact(spark, fact_path).select(*both.columns)) == rows(both)


def test_reruns_leave_no_stale_rows(spark, tmp_path):
    """A rerun that lost its late row, or all rows, leaves nothing of the earlier run; other loads stay."""
    root, table = str(tmp_path / "logs"), str(tmp_path / "t")
    d0, d1, _ = report_days(D0).values()
    stay = lambda who, day: {"custom_uuid": who, "rectime": day_bounds_ms(day)[0],
                             "data": {"launcher_page_stay": [{"time": 1, "enter": 1, "exit": 2}]}}
    write_raw(root, d1, "a.gz", [stay("other", d1)])
    write_raw(root, d0, "a.gz", [stay("on-time", d0), stay("late", d1)])
    for day in (d1, d0):
        jobs.ingest_page_stay(spark, root, table, day)
    names = lambda: sorted(r.custom_uuid for r in tables.read_page_stay(spark, table).collect())
    assert names() == ["late", "on-time", "other"]
    write_raw(root, d0, "a.gz", [stay("on-time", d0)])
    jobs.ingest_page_stay(spark, root, table, d0)
    assert names() == ["on-time", "other"]
    write_raw(root, d0, "a.gz", [])
    jobs.ingest_page_stay(spark, root, table, d0)
    assert names() == ["other"]

    out = str(tmp_path / "r")
    report = spark.createDataFrame([(20240130, "a", 1)], "date int, k string, v long")
    other = spark.createDataFrame([(20240129, "b", 1)], "date int, k string, v long")
    jobs.publish_report(spark, other, out, report_day=D0 - dt.timedelta(days=1))
    jobs.publish_report(spark, report, out, report_day=D0)
    assert rows(tables.read_report(spark, out, report.columns)) == [(20240129, "b", 1), (20240130, "a", 1)]
    jobs.publish_report(spark, report.where("false"), out, report_day=D0)
    assert rows(tables.read_report(spark, out, report.columns)) == [(20240129, "b", 1)]
    facts = str(tmp_path / "f")
    fact = sales.daily_order_fact(fx.sales_orders(spark, SMALL, [D0]), D0, preset=fixture_packages())
    tables.store_daily_fact(fact, facts, D0)
    assert tables.read_daily_fact(spark, facts).count() == fact.count() > 0
    tables.store_daily_fact(fact.where("false"), facts, D0)
    assert tables.read_daily_fact(spark, facts).count() == 0


def test_catalog_tables_are_pruned_and_replaced(spark, log_root):
    d0, d1, _ = report_days(D0).values()
    try:
        for day in (d1, d0, d0):
            jobs.ingest_page_stay(spark, log_root, "stays", day, fmt="parquet")
        want = exposure.page_stay_rows(fx.launcher_logs(spark, SMALL, [d0, d1]))
        assert rows(tables.read_page_stay(spark, "stays").select(*want.columns)) == rows(want)
        pruned = tables.read_page_stay(spark, "stays", [d0])
        plan = pruned._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(dt" in plan and "2024-01-30" in plan
        tables.store_page_stay(want.where("false"), "stays", d0, fmt="parquet")
        assert {r.dt for r in tables.read_page_stay(spark, "stays").select("dt").distinct().collect()} == {iso(d1)}
        report = spark.createDataFrame([(20240130, "a", 1)], "date int, k string, v long")
        for again in (report, report, report.where("false")):
            jobs.publish_report(spark, again, "daily_report", report_day=D0)
        assert tables.read_report(spark, "daily_report").count() == 0
    finally:
        for name in ("stays", "daily_report"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_log_scalars_may_be_text_fractions_or_junk(spark, tmp_path):
    """Whatever type the producer chose, a valid stay is stored whole; junk is NULL and counted."""
    root, table = str(tmp_path / "2023-12-31" / "logs"), str(tmp_path / "t")     # a dated root
    ms, s = day_bounds_ms(D0)[0] + 5000, day_bounds_ms(D0)[0] // 1000
    one = lambda who, rectime, **item: {"custom_uuid": who, "site": "ALI", "rectime": rectime,
                                        "data": {"launcher_page_stay": [item], "home_item_click": [
                                            {"time": "x", "position": "1,1", "title": "t"}]}}
    write_raw(root, D0, "a.gz", [
        one("int", ms, time=1, enter=s, exit=s + 60), one("text-time", ms, time="12:30", enter=s, exit=s + 60),
        one("fraction", ms + 0.5, time=1.5, enter=s + 0.25, exit=s + 60.75),
        one("quoted", str(ms), time=1, enter=str(s), exit=str(s + 60)),
        one("junk", ms, time=1, enter=10**18, exit="soon"), one("no-time", ms, enter=s, exit=s + 60)])
    with gzip.open(os.path.join(root, iso(D0), "h99", "b.gz"), "wt") as fh:
        fh.write("{broken\n")
    counts = jobs.ingest_page_stay(spark, root, table, D0)
    assert counts == {"records": 7, "malformed": 1, "bad_rectime": 0, "items": 5, "bad_enter": 1, "bad_exit": 1}
    got = {r.custom_uuid: (r.dt, r.staySeconds, r.enter is None) for r in tables.read_page_stay(spark, table).collect()}
    assert got == {"int": (iso(D0), 60, False), "text-time": (iso(D0), 60, False), "fraction": (iso(D0), 60, False),
                   "quoted": (iso(D0), 60, False), "junk": (iso(D0), None, True)}
    assert {r.log_day for r in logs.read_logs(spark, root, [D0]).collect()} == {iso(D0)}
    clicks = heatmap.click_rows(logs.read_logs(spark, root, [D0]), day_col="log_day")
    assert clicks.count() == 6 and clicks.where("category is null").count() == 6


def test_stays_across_dst_changes_keep_their_length(spark):
    zone = "America/New_York"
    instants = {"spring": 1710053940, "autumn": 1730611740}    # 01:59 before the gap and the overlap
    for name, start in instants.items():
        record = [(name, str(start * 1000), "ALI", [("1", str(start), str(start + 120), "t")])]
        df = spark.createDataFrame(record, "custom_uuid string, rectime string, site string, "
                                   "items array<struct<time:string,enter:string,exit:string,title:string>>")
        df = df.selectExpr("*", "'a' account", "'v' vercode", "'v' vername", "'d' device_name",
                           "named_struct('launcher_page_stay', items) data")
        stays = exposure.page_stay_rows(df, tz=zone)
        assert [r.staySeconds for r in stays.collect()] == [120]
        day = stays.first().dt
        assert exposure.exposure_cube(stays, [day]).where("id_1 = 0").first().playNum == 1


def test_append_mode_duplicates(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1)], "dt string, v int")
    tables.write_partitions(df, path, ["dt"], mode="append")
    tables.write_partitions(df, path, ["dt"], mode="append")
    assert spark.read.parquet(path).count() == 2
    tables.write_partitions(df, path, ["dt"], mode="replace")
    assert spark.read.parquet(path).count() == 1


def test_jdbc_arguments_are_checked(spark):
    # no database is started in tests; only the option validation is exercised
    with pytest.raises(ValueError):
        jdbc.jdbc_source(spark, "jdbc:x://h/db", table="t", query="select 1")
    with pytest.raises(ValueError):
        jdbc.jdbc_source(spark, "jdbc:x://h/db", table="t", partition_column="id")
    with pytest.raises(ValueError):
        jdbc.jdbc_sink(spark.range(1), "jdbc:x://h/db", "t", mode="upsert")


def test_streaming_ingest_is_incremental_and_exactly_once(spark, log_root, tmp_path):
    d0, d1, d7 = report_days(D0).values()
    src = str(tmp_path / "src")
    sink = str(tmp_path / "sink")
    write_log_days(spark, src, [d7, d1])
    glob = f"{src}/*/*/*.gz"
    page_stay_stream(spark, glob, sink).awaitTermination()
    first = tables.read_table(spark, sink, PAGE_STAY).count()
    write_log_days(spark, src, [d0])
    # a restart elsewhere: another session, no checkpoint named
    page_stay_stream(spark.newSession(), glob, sink).awaitTermination()
    page_stay_stream(spark, glob, sink).awaitTermination()   # nothing new
    got = tables.read_table(spark, sink, PAGE_STAY)   # declared schema: dt stays a string
    want = exposure.page_stay_rows(fx.launcher_logs(spark, SMALL, [d7, d1, d0]))
    assert got.count() == want.count() > first > 0
    assert rows(got.select(*want.columns)) == rows(want)


def test_malformed_lines_kept_in_corrupt_column(spark, tmp_path):
    root = str(tmp_path)
    folder = os.path.join(root, iso(D0), "h00")
    os.makedirs(folder)
    with gzip.open(os.path.join(folder, "x.gz"), "wt") as fh:
        fh.write(json.dumps({"custom_uuid": "u1", "site": "ALI", "rectime": 1}) + "\n")
        fh.write("{not json\n")
    df = logs.read_logs(spark, root, [D0], corrupt_column="_corrupt").cache()
    got = {(r.custom_uuid, r._corrupt) for r in df.collect()}
    df.unpersist()
    assert got == {(None, "{not json"), ("u1", None)}


def test_max_records_per_file(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).selectExpr("'d' AS dt", "id").coalesce(1)
    tables.write_partitions(df, path, ["dt"], max_records_per_file=30)
    files = [f for f in os.listdir(os.path.join(path, "dt=d")) if f.endswith(".parquet")]
    assert len(files) == 4 and spark.read.parquet(path).count() == 100


def test_publish_report_needs_a_jdbc_table(spark, tmp_path):
    from daybook.plans import jobs

    report = spark.createDataFrame([(20240130, "a", 1)], "date int, k string, v long")
    with pytest.raises(ValueError, match="jdbc_table"):
        jobs.publish_report(spark, report, str(tmp_path / "r"), jdbc_url="jdbc:x://h/db")
    # the file table was written before the export step
    assert spark.read.parquet(str(tmp_path / "r")).count() == 1
