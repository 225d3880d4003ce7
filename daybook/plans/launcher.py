"""One pass over the launcher logs for both of their reports.

A gzip file can't be split and is dear to read; page stays (R6, R7) and clicks (R8) are
arrays of the same records. ``launcher_items`` explodes both at once, ``ingest_logs``
writes them in one job to a run folder, and the partitions of two catalog tables are
turned to it: each day's logs are read once, whatever reports use that day later.

What the logs hold that can't be used is counted while they are written
(``DataFrame.observe``), not by further scans. The write has no shuffle, so a task
that is run again is counted once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import BASELINES, epoch_count, iso, report_days, wall_clock
from ..functions.labels import label_map
from ..functions.presets import MIN_GROUP_COUNT, SITE_CHANNELS
from ..sources import logs as log_source
from ..sources.commits import ensure_table, new_run, turn_to, write_run
from ..sources.schemas import CLICK_ITEM, PAGE_STAY, PAGE_STAY_ITEM
from . import heatmap
from .exposure import unreadable, watch_records

STAY, CLICK = "stay", "click"
MALFORMED = "_malformed"
CLICK_COLUMNS = ("custom_uuid", "site", "category", "position", "title", "type", "dt")
_ITEM = ("time", "enter", "exit", "title", "category", "position", "type")
_ITEM_TYPE = "struct<kind:string," + ",".join(f"{c}:string" for c in _ITEM) + ">"


def _items(path: str, fields: list[str], kind: str) -> Column:
    """The elements of one array of a record, with every column of both kinds."""
    one = lambda e: F.struct(F.lit(kind).alias("kind"), *(
        (e[c].cast("string") if c in fields else F.lit(None).cast("string")).alias(c) for c in _ITEM)).cast(_ITEM_TYPE)
    return F.coalesce(F.transform(path, one), F.array().cast(f"array<{_ITEM_TYPE}>"))


def launcher_items(logs: DataFrame, *, tz: str = "UTC", click_day: str | None = None,
                   watch: Observation | None = None) -> DataFrame:
    """One row per page stay and per click with a ``time``, in one pass (``kind``: stay or click).

    The columns of ``exposure.page_stay_rows`` and of ``heatmap.click_rows``, NULL where the kind lacks
    them. A stay's ``dt`` is its record's day, a click's the column ``click_day`` (the day of its
    folder) where given. ``watch`` counts items of both kinds and their unreadable epochs.
    """
    both = F.concat(_items("data.launcher_page_stay", PAGE_STAY_ITEM.fieldNames(), STAY),
                    _items("data.home_item_click", CLICK_ITEM.fieldNames(), CLICK))
    carried = ["custom_uuid", "account", "rectime", "site", "vercode", "vername", "device_name"]
    flat = (logs.select(*carried, *([F.col(click_day).alias("_click_day")] if click_day else []), F.explode(both).alias("e"))
            .select("*", "e.*").drop("e").where("time is not null"))
    if watch is not None:
        flat = flat.observe(watch, F.count_if(F.col("kind") == STAY).alias("items"), F.count_if(F.col("kind") == CLICK).alias("clicks"),
                            unreadable("enter", "SECOND").alias("bad_enter"), unreadable("exit", "SECOND").alias("bad_exit"))
    day = F.to_date(wall_clock(epoch_count("rectime", "MILLISECOND"), "MILLISECOND", tz))
    flat = flat.withColumns({"enter": epoch_count("enter"), "exit": epoch_count("exit"), "_day": day})
    is_stay = F.col("kind") == STAY
    only = lambda c: F.when(is_stay, F.col(c)).alias(c)
    dt = F.col("_day").cast("string")
    return flat.select(
        "kind", "custom_uuid", only("account"), F.when(is_stay, F.col("_day")).alias("date"),
        label_map("site", SITE_CHANNELS).alias("site"), only("vercode"), only("vername"), only("device_name"),
        wall_clock("enter", "SECOND", tz).alias("enter"), wall_clock("exit", "SECOND", tz).alias("exit"),
        (F.col("exit") - F.col("enter")).alias("staySeconds"), "title", "category", "position", "type",
        (F.when(is_stay, dt).otherwise(F.col("_click_day")) if click_day else dt).alias("dt"))


def ingest_logs(spark: SparkSession, log_root: str, stays: str, clicks: str, runs: str, load_day, *,
                tz: str = "UTC", fmt: str = "orc") -> dict[str, int]:
    """Flatten one day folder of logs into the catalog tables ``stays`` and ``clicks``, reading it once.

    ``runs`` is a folder on the shared storage for the runs' files. Rerunning a ``load_day`` replaces its
    partitions of both tables; a run that fails leaves them as they were. Returns the counts of records,
    malformed lines, items, clicks and unreadable epochs that the write itself came across.
    """
    day, run = iso(load_day), new_run()
    records, items = Observation("records"), Observation("items")
    logs = watch_records(log_source.read_logs(spark, log_root, [load_day], corrupt_column=MALFORMED), records, MALFORMED)
    rows = launcher_items(logs, tz=tz, click_day="log_day", watch=items)
    written = write_run(rows, f"{runs.rstrip('/')}/{run}", ["kind", "dt"], fmt=fmt)
    for name, kind, columns in ((stays, STAY, PAGE_STAY.fieldNames()), (clicks, CLICK, CLICK_COLUMNS)):
        like = rows.select(*columns).withColumn("load_date", F.lit(day))
        ensure_table(spark, name, like, ["load_date", "dt"], fmt)
        turn_to(spark, name, [({"load_date": day, "dt": values["dt"]}, folder) for values, folder in written
                              if values["kind"] == kind], owned=("load_date", day), track="dt", run=run)
    return {**records.get, **items.get}


def stored_clicks(spark: SparkSession, clicks: str, days=None) -> DataFrame:
    """Clicks of the table, pruned to the partitions of ``days``."""
    df = spark.table(clicks)
    return (df if days is None else df.where(F.col("dt").isin([iso(d) for d in days]))).select(*CLICK_COLUMNS)


def stored_heatmap(spark: SparkSession, clicks: str, report_day, *, min_count: int = MIN_GROUP_COUNT,
                   title_min_count: int | None = None, missing_category: str | None = None,
                   baselines: Mapping[str, int] = BASELINES) -> DataFrame:
    """R8 from stored clicks: no log is read again for a report or baseline day. Every day must have been loaded."""
    days = report_days(report_day, baselines)
    loaded = {r["load_date"] for r in spark.table(clicks).select("load_date").distinct().collect()}
    if lacking := sorted({iso(d) for d in days.values()} - loaded):
        raise log_source.MissingInputError(f"days not loaded into {clicks}: {', '.join(lacking)}")
    rows = stored_clicks(spark, clicks, days.values())
    if missing_category is not None:
        rows = rows.fillna({"category": missing_category})
    return heatmap.click_heatmap_report(rows, report_day, min_count=min_count, title_min_count=title_min_count,
                                        baselines=baselines)
