"""Page exposure from stored audiences: reports that never touch a raw stay or a user id.

When a load of page stays has been stored, its *audience* is derived once: per (dt, site,
title) the users as bitmaps over dictionary codes, plays and seconds as sums. Loads are
merged by OR and addition, so a late record only adds to its day, and the exposure of any
days, weeks or months is one small aggregation with exact distinct users.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import BASELINES, DAY, as_day, date_key, iso, report_days
from ..functions.metrics import ratio, round2
from ..functions.presets import MAX_STAY_SECONDS
from ..operators.compare import compare_periods
from ..operators.distinct import CODE, bitmap_rows, empty_codes, merged_counts, new_codes
from ..sources import changes, tables
from ..sources.commits import commit_partitions, new_run, partitions
from .exposure import EXPOSURE_METRICS

USER = "custom_uuid"
KEYS = ["site", "title"]


def audience_rows(page_stay: DataFrame, codes: DataFrame, max_stay: int = MAX_STAY_SECONDS) -> DataFrame:
    """(dt, site, title, bucket, members, plays, seconds) of the valid stays (those of 0 to ``max_stay`` s)."""
    per_user = (page_stay.where(F.col("staySeconds").between(0, max_stay)).groupBy("dt", *KEYS, USER)
                .agg(F.count(USER).alias("_plays"), F.sum("staySeconds").alias("_seconds")))
    return bitmap_rows(per_user, ["dt", *KEYS], USER, codes, {"plays": F.col("_plays"), "seconds": F.col("_seconds")})


def _metrics() -> list[Column]:
    plays, users, seconds = F.col("plays"), F.col("users"), F.col("seconds")
    return [plays.alias("playNum"), round2(seconds / F.lit(3600)).alias("playTime"), users.alias("users"),
            round2(ratio(plays, users)).alias("avgPlayNum"), round2(ratio(seconds, users) / F.lit(60)).alias("avgPlayTime")]


def exposure_cube(audience: DataFrame, days: Iterable) -> DataFrame:
    """The cube of ``exposure.exposure_cube`` (A5) from stored audiences."""
    rows = audience.where(F.col("dt").isin([iso(d) for d in days]))
    cube = merged_counts(rows, KEYS, ["plays", "seconds"], always=["dt"])
    return cube.select("dt", *KEYS, "id_1", *_metrics())


def period_cube(audience: DataFrame, periods: Mapping[str, Iterable]) -> DataFrame:
    """``GROUP BY period, CUBE(site, title)`` where a period is any set of days; periods may overlap."""
    of_day: dict[str, list[str]] = {}
    for name, days in periods.items():
        for day in days:
            of_day.setdefault(iso(day), []).append(name)
    rows = audience.where(F.col("dt").isin(list(of_day)))
    named = F.create_map(*(x for d, names in sorted(of_day.items()) for x in (F.lit(d), F.array(*map(F.lit, names)))))
    rows = rows.withColumn("period", F.explode(named[F.col("dt")]))
    cube = merged_counts(rows, KEYS, ["plays", "seconds"], always=["period"])
    return cube.select("period", *KEYS, "id_1", *_metrics())


def exposure_report(audience: DataFrame, report_day, *, baselines: Mapping[str, int] = BASELINES) -> DataFrame:
    """R7 from stored audiences."""
    cube = exposure_cube(audience, report_days(report_day, baselines).values())
    return compare_periods(cube, day_col="dt", report_day=report_day, keys={"site": "channelName", "title": "typeName"},
                           metrics=EXPOSURE_METRICS, baselines=baselines, day_value=iso)


def week(last) -> list:
    """The seven days that end with ``last``."""
    return [as_day(last) - n * DAY for n in range(7)]


def weekly_exposure_report(audience: DataFrame, report_day) -> DataFrame:
    """R7 over whole weeks: the seven days until the report day against the seven before, users counted once a week."""
    ends = report_days(report_day, {"Week": 7})
    cube = period_cube(audience, {iso(end): week(end) for end in ends.values()})
    return compare_periods(cube, day_col="period", report_day=report_day, keys={"site": "channelName", "title": "typeName"},
                           metrics=EXPOSURE_METRICS, baselines={"Week": 7}, day_value=iso)


def update_audience(spark: SparkSession, page_stay: str, name: str, load_day, *, fmt: str = "orc") -> None:
    """Derive the audience of one stored load of page stays: catalog tables ``name`` and ``name_codes``.

    A rerun replaces the load's audience; codes once given stay. A run that fails in between leaves
    new codes without an audience, which the rerun uses. Runs must not overlap: two would give the
    same code twice.
    """
    codes_name = f"{name}_codes"
    stays = tables.read_table(spark, page_stay, tables.PAGE_STAY_TABLE, fmt=fmt).where(F.col("load_date") == iso(load_day))
    codes = spark.table(codes_name).select(USER, CODE) if spark.catalog.tableExists(codes_name) else empty_codes(stays, USER)
    run = new_run()
    commit_partitions(new_codes(stays, USER, codes).withColumn("run", F.lit(run)), codes_name, ["run"], run=run)
    rows = audience_rows(stays, spark.table(codes_name).select(USER, CODE))
    commit_partitions(rows, name, ["load_date", "dt"], owned=("load_date", iso(load_day)), track="dt")


def affected_reports(days: Iterable, baselines: Mapping[str, int] = BASELINES) -> list:
    """The report days that read one of ``days``: the days themselves, and those they are a baseline of."""
    lags = [0, *baselines.values()]
    return sorted({as_day(d) + n * DAY for d in days for n in lags})


def refresh_exposures(spark: SparkSession, name: str, reports: str, report_day=None, *,
                      baselines: Mapping[str, int] = BASELINES) -> list:
    """Build the report of ``report_day`` and rebuild the stored reports that late records have changed.

    ``reports`` is the catalog table of R7 (``date`` partitions). Days of the audience table ``name`` that
    changed since the last refresh give the affected report days; of those the stored ones are
    rebuilt, and no other. Returns the report days built.
    """
    todo = changes.pending(spark, name, reports)
    stored = {p["date"] for p in partitions(spark, reports)} if spark.catalog.tableExists(reports) else set()
    build = {d for d in affected_reports(todo.days, baselines) if str(date_key(d)) in stored}
    build |= {as_day(report_day)} if report_day is not None else set()
    for day in sorted(build):
        report = exposure_report(spark.table(name), day, baselines=baselines)
        tables.replace_table_partition(report, reports, ("date", date_key(day)))
    changes.taken_in(spark, name, reports, todo.runs)
    return sorted(build)
