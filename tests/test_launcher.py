"""Page stays and clicks from one pass over the gzip logs, with what is unreadable counted on the way."""

import datetime as dt
import gzip
import os

import pytest
from conftest import rows
from pyspark.sql import Observation
from pyspark.sql import functions as F
from test_sources import SMALL, write_log_days, write_raw

from daybook.cli import main
from daybook.functions.dates import day_bounds_ms, iso, report_days
from daybook.plans import catalog, exposure, heatmap, jobs, launcher
from daybook.sources import fixtures as fx
from daybook.sources import logs

D0 = fx.EVENTS_DAY
LIMITS = {"min_count": fx.FIXTURE_MIN_GROUP, "title_min_count": fx.FIXTURE_MIN_TITLE}


@pytest.fixture(scope="module")
def log_root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("launcher"))
    write_log_days(spark, root, report_days(D0).values())
    return root


@pytest.fixture
def names(spark, tmp_path):
    drop = lambda: [spark.sql(f"DROP TABLE IF EXISTS {t}") for t in ("l_stays", "l_clicks")]
    drop()
    yield "l_stays", "l_clicks", str(tmp_path / "runs")
    drop()


def test_both_reports_from_one_pass_per_day(spark, log_root, names):
    days = list(report_days(D0).values())
    for day in (*days, D0):                       # the last one again
        counts = launcher.ingest_logs(spark, log_root, *names, day)
    stays, clicks, _ = names
    read = logs.read_logs(spark, log_root, days)
    assert rows(spark.table(stays).drop("load_date").select(*exposure.page_stay_rows(read).columns)) == rows(exposure.page_stay_rows(read))
    want = heatmap.click_rows(read, day_col="log_day")
    assert rows(launcher.stored_clicks(spark, clicks).select(*want.columns)) == rows(want)
    of_day = logs.read_logs(spark, log_root, [D0])
    assert counts == {"records": of_day.count(), "malformed": 0, "bad_rectime": 0, "bad_enter": 0, "bad_exit": 0,
                      "items": exposure.page_stay_rows(of_day).count(), "clicks": heatmap.click_rows(of_day).count()}
    got = launcher.stored_heatmap(spark, clicks, D0, **LIMITS)
    assert rows(got) == rows(catalog.click_heatmap_report(spark, SMALL)) != []
    assert rows(exposure.page_exposure_report(spark.table(stays), D0)) == rows(catalog.page_exposure_report(spark, SMALL))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "FileScan json" not in plan and "FileScan orc" in plan
    with pytest.raises(logs.MissingInputError, match="2024-01-31"):
        launcher.stored_heatmap(spark, clicks, D0 + dt.timedelta(days=1))


def test_the_pass_scans_each_file_once(spark, log_root):
    items = launcher.launcher_items(logs.read_logs(spark, log_root, [D0]), click_day="log_day")
    stays = exposure.page_stay_rows(logs.read_logs(spark, log_root, [D0]))
    for df in (items, stays):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan json") == 1 and "Exchange" not in plan


def junk(root):
    ms, s = day_bounds_ms(D0)[0] + 5000, day_bounds_ms(D0)[0] // 1000
    record = lambda who, rectime, stay, click: {
        "custom_uuid": who, "site": "ALI", "rectime": rectime,
        "data": {"launcher_page_stay": stay, "home_item_click": click}}
    write_raw(root, D0, "a.gz", [
        record("both", ms, [{"time": 1, "enter": s, "exit": s + 5, "title": "t"}], [{"time": 1, "position": "1,1"}] * 2),
        record("late", ms - 86_400_000, [{"time": 1, "enter": s, "exit": "soon"}], [{"time": 2, "position": "1,2"}]),
        record("no-day", "?", [{"time": 1, "enter": 10 ** 18, "exit": s}], None),
        record("no-items", ms, None, None), record("empty", ms, [], []), {"custom_uuid": "no-data"},
        record("no-time", ms, [{"enter": s}], [{"position": "1,1"}])])
    with gzip.open(os.path.join(root, iso(D0), "h99", "b.gz"), "wt") as fh:
        fh.write("{broken\n[1,\n")


def test_junk_is_counted_by_the_write(spark, tmp_path, names):
    root = str(tmp_path / "logs")
    junk(root)
    counts = launcher.ingest_logs(spark, root, *names, D0)
    assert counts == {"records": 9, "malformed": 2, "bad_rectime": 1, "items": 3, "clicks": 3, "bad_enter": 1, "bad_exit": 1}
    got = {(r.custom_uuid, r.dt, r.staySeconds) for r in spark.table(names[0]).collect()}
    assert got == {("both", iso(D0), 5), ("late", iso(D0 - dt.timedelta(days=1)), None), ("no-day", None, None)}
    assert {(r.custom_uuid, r.dt, r.position) for r in spark.table(names[1]).collect()} == {
        ("both", iso(D0), "1,1"), ("late", iso(D0), "1,2")}
    # a rerun on a folder that has shrunk drops what it no longer has
    other = str(tmp_path / "fewer")
    write_raw(other, D0, "a.gz", [{"custom_uuid": "x", "rectime": day_bounds_ms(D0)[0], "data": {"home_item_click": [{"time": 1}]}}])
    launcher.ingest_logs(spark, other, *names, D0)
    assert spark.table(names[0]).count() == 0 and [r.custom_uuid for r in spark.table(names[1]).collect()] == ["x"]


def test_a_failed_pass_leaves_both_tables(spark, log_root, names, monkeypatch):
    launcher.ingest_logs(spark, log_root, *names, D0)
    before = [rows(spark.table(n)) for n in names[:2]]
    real = launcher.launcher_items
    monkeypatch.setattr(launcher, "launcher_items", lambda *a, **k: real(*a, **k).withColumn("title", F.raise_error(F.lit("lost")).cast("string")))
    with pytest.raises(Exception, match="lost"):
        launcher.ingest_logs(spark, log_root, *names, D0)
    assert [rows(spark.table(n)) for n in names[:2]] == before


def test_the_heat_map_counts_malformed_lines(spark, log_root, tmp_path):
    root = str(tmp_path / "logs")
    write_log_days(spark, root, report_days(D0).values())
    for d in (D0, D0 - dt.timedelta(days=7)):
        with gzip.open(os.path.join(root, iso(d), "h00", "bad.json.gz"), "wt") as fh:
            fh.write("{broken\n")
    watch = Observation("records")
    report = jobs.heatmap_job(spark, root, D0, watch=watch, **LIMITS)
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan json") == 3      # a day each
    assert rows(report) == rows(catalog.click_heatmap_report(spark, SMALL))
    n = logs.read_logs(spark, root, report_days(D0).values()).count()
    assert watch.get == {"records": n, "malformed": 2, "bad_rectime": 0}


def test_jobs_from_the_command_line(spark, log_root, names, tmp_path, capsys):
    stays, clicks, runs = names
    for day in report_days(D0).values():
        main(["ingest-logs", "--date", iso(day), "--logs", log_root, "--page-stay", stays, "--clicks", clicks, "--runs", runs])
        main(["update-audience", "--date", iso(day), "--page-stay", stays, "--audience", "l_aud"])
    assert "malformed=0" in capsys.readouterr().err
    try:
        out = {k: str(tmp_path / k) for k in ("exposure", "week", "heat", "logs")}
        main(["page-exposure", "--date", iso(D0), "--audience", "l_aud", "--out", out["exposure"]])
        main(["weekly-exposure", "--date", iso(D0), "--audience", "l_aud", "--out", out["week"]])
        limits = ["--min-count", str(fx.FIXTURE_MIN_GROUP), "--title-min-count", str(fx.FIXTURE_MIN_TITLE)]
        main(["heatmap", "--date", iso(D0), "--clicks", clicks, "--out", out["heat"], *limits])
        main(["heatmap", "--date", iso(D0), "--logs", log_root, "--out", out["logs"], *limits])
        assert "records=" in capsys.readouterr().err
        for key, query in (("exposure", catalog.page_exposure_report), ("heat", catalog.click_heatmap_report), ("logs", catalog.click_heatmap_report)):
            want = query(spark, SMALL)
            assert rows(spark.read.parquet(out[key]).select(*want.columns)) == rows(want)
        assert spark.read.parquet(out["week"]).count() > 0
    finally:
        for name in ("l_aud", "l_aud_codes"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
