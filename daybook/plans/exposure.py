"""Launcher page exposure: page-stay ingest (R6) and the exposure report."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.dates import BASELINES, epoch_count, iso, report_days, wall_clock
from ..functions.labels import label_map
from ..functions.metrics import ratio, round2
from ..functions.presets import MAX_STAY_SECONDS, SITE_CHANNELS
from ..operators.compare import compare_periods
from ..operators.flatten import flatten_events
from ..operators.rollup import rollup

RECORD_FIELDS = ("custom_uuid", "account", "rectime", "vercode", "vername", "device_name", "site")

EXPOSURE_METRICS = {
    "playNum": ("totalPlayNum", "playNum"),
    "playTime": ("totalPlayTime", "playTime"),
    "users": ("totalUserCount", "userCount"),
    "avgPlayNum": ("averagePlayNum", "avgPlayNum"),
    "avgPlayTime": ("averagePlayTime", "avgPlayTime"),
}


def unreadable(column: str, unit: str = "SECOND") -> Column:
    """Rows whose epoch field holds something that is no epoch."""
    return F.count_if(F.col(column).isNotNull() & epoch_count(column, unit).isNull())


def watch_records(logs: DataFrame, watch: Observation, corrupt_column: str) -> DataFrame:
    """Count records, malformed lines and unreadable record times while the logs pass by (no scan of their own)."""
    return logs.observe(watch, F.count(F.lit(1)).alias("records"),
                        F.count_if(F.col(corrupt_column).isNotNull()).alias("malformed"),
                        unreadable("rectime", "MILLISECOND").alias("bad_rectime"))


def page_stay_rows(logs: DataFrame, tz: str = "UTC", watch: Observation | None = None) -> DataFrame:
    """Flatten ``data.launcher_page_stay`` into the stored page-stay rows.

    ``date``/``dt`` come from each record's ``rectime`` (so a late record lands
    on its own day), ``enter``/``exit`` become local wall-clock timestamps, the
    site code becomes a channel. Items without ``time`` are dropped. Epoch fields may
    be numbers or text; one that can't be read is NULL, and counted by ``watch``.
    ``staySeconds`` is the difference of the two instants.
    """
    flat = flatten_events(logs, "data.launcher_page_stay", ["enter", "exit", "title"],
                          keep=RECORD_FIELDS, not_null=["time"])
    if watch is not None:
        flat = flat.observe(watch, F.count(F.lit(1)).alias("items"), unreadable("enter").alias("bad_enter"),
                            unreadable("exit").alias("bad_exit"))
    day = F.to_date(wall_clock(epoch_count("rectime", "MILLISECOND"), "MILLISECOND", tz))
    flat = flat.withColumns({"enter": epoch_count("enter"), "exit": epoch_count("exit")})
    return flat.select(
        "custom_uuid", "account", day.alias("date"),
        label_map("site", SITE_CHANNELS).alias("site"),
        "vercode", "vername", "device_name",
        wall_clock("enter", "SECOND", tz).alias("enter"),
        wall_clock("exit", "SECOND", tz).alias("exit"),
        (F.col("exit") - F.col("enter")).alias("staySeconds"),
        "title",
        day.cast("string").alias("dt"),
    )


def exposure_cube(page_stay: DataFrame, days: Iterable, max_stay: int = MAX_STAY_SECONDS) -> DataFrame:
    """``GROUP BY dt, CUBE(site, title)`` over valid stays of ``days`` (A5).

    A stay counts when it lasts from 0 to ``max_stay`` s, as a difference of instants.
    ``count(custom_uuid)`` skips NULL users; averages are NULL when a group has
    no user instead of a division error. Stays are first summed per (dt, site,
    title, user), map-side, so the cube expands that and not every stay.
    """
    stays = (page_stay.where(F.col("dt").isin([iso(d) for d in days]))
             .where(F.col("staySeconds").between(0, max_stay))
             .groupBy("dt", "site", "title", "custom_uuid")
             .agg(F.count("custom_uuid").alias("_plays"), F.sum("staySeconds").alias("_secs")))
    plays = F.sum("_plays")
    users = F.count_distinct("custom_uuid")
    seconds = F.sum("_secs")
    metrics = [
        plays.alias("playNum"),
        round2(seconds / F.lit(3600)).alias("playTime"),
        users.alias("users"),
        round2(ratio(plays, users)).alias("avgPlayNum"),
        round2(ratio(seconds, users) / F.lit(60)).alias("avgPlayTime"),
    ]
    return rollup(stays, ["site", "title"], metrics, always=["dt"])


def page_exposure_report(page_stay: DataFrame, report_day, *, max_stay: int = MAX_STAY_SECONDS,
                         baselines: Mapping[str, int] = BASELINES) -> DataFrame:
    """Exposure per channel x title with day-over-day and week-over-week change."""
    days = report_days(report_day, baselines)
    cube = exposure_cube(page_stay, days.values(), max_stay)
    return compare_periods(cube, day_col="dt", report_day=report_day,
                           keys={"site": "channelName", "title": "typeName"},
                           metrics=EXPOSURE_METRICS, baselines=baselines, day_value=iso)
