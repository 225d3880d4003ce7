"""End-to-end report jobs: inputs -> report -> rerun-safe output.

Each job is a thin composition of the report functions with the sources and
sinks; the report functions stay pure ``DataFrame -> DataFrame``. The report
date is always a parameter (never the wall clock inside a query).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import BASELINES, as_day, date_key, report_days
from ..functions.presets import MIN_GROUP_COUNT, PACKAGES_DAILY_FACT, LabelPreset
from ..sources import changes, export, jdbc, tables
from ..sources import logs as log_source
from ..sources.commits import commit_partitions, drop_partition, partitions
from . import exposure, heatmap, sales


def ingest_page_stay(spark: SparkSession, log_root: str, table_path: str, load_day, *,
                     tz: str = "UTC", fmt: str = "orc") -> dict[str, int]:
    """Flatten one day folder of launcher logs into the page-stay table.

    Fails with ``MissingInputError`` when the folder has no log file. Rerunning
    the same ``load_day`` replaces that load whole. The folder is read once: records,
    malformed lines and unreadable epochs are counted by the write and returned.
    """
    records, items = Observation("records"), Observation("items")
    logs = log_source.read_logs(spark, log_root, [load_day], corrupt_column="_malformed")
    rows = exposure.page_stay_rows(exposure.watch_records(logs, records, "_malformed"), tz=tz, watch=items)
    tables.store_page_stay(rows, table_path, load_day, fmt=fmt)
    return {**records.get, **items.get}


def page_exposure_job(spark: SparkSession, log_root: str, table_path: str, report_day, *,
                      tz: str = "UTC", fmt: str = "orc",
                      baselines: Mapping[str, int] = BASELINES) -> DataFrame:
    """R6 then R7: ingest the report day's logs, report from the stored table
    (partition-pruned to the report and baseline days)."""
    ingest_page_stay(spark, log_root, table_path, report_day, tz=tz, fmt=fmt)
    days = report_days(report_day, baselines)
    stays = tables.read_page_stay(spark, table_path, days.values(), fmt=fmt)
    return exposure.page_exposure_report(stays, report_day, baselines=baselines)


def heatmap_job(spark: SparkSession, log_root: str, report_day, *, min_count: int = MIN_GROUP_COUNT,
                title_min_count: int | None = None, missing_category: str | None = None,
                baselines: Mapping[str, int] = BASELINES, watch: Observation | None = None) -> DataFrame:
    """R8 from the log folders of the report and baseline days (every folder checked
    first; a row's day is its folder's day). A click without a category stays NULL;
    ``missing_category`` labels it instead, for logs that lack the field.

    ``watch`` counts records, malformed lines and unreadable record times of all folders while the
    report is made; the report then takes the form that reads every log once. A site that
    reports daily loads clicks with ``launcher.ingest_logs`` instead and never reads a log again."""
    days = report_days(report_day, baselines)
    logs = log_source.read_logs(spark, log_root, days.values(), corrupt_column="_malformed" if watch else None)
    if watch is not None:
        logs = exposure.watch_records(logs, watch, "_malformed")
    clicks = heatmap.click_rows(logs, day_col="log_day", missing_category=missing_category)
    report = heatmap.click_heatmap_report if watch is None else heatmap.click_heatmap_report_one_pass
    return report(clicks, report_day, min_count=min_count, title_min_count=title_min_count, baselines=baselines)


def monthly_sales_job(spark: SparkSession, orders: DataFrame, fact_path: str, report_day, *,
                      preset: LabelPreset = PACKAGES_DAILY_FACT, tz: str = "UTC") -> DataFrame:
    """R4 then R5: replace the report day in the stored day fact, then cube the
    whole fact by month. The written table cuts the lineage between stages."""
    fact = sales.daily_order_fact(orders, as_day(report_day), preset=preset, tz=tz)
    tables.store_daily_fact(fact, fact_path, as_day(report_day))
    return sales.monthly_sales_cube(tables.read_daily_fact(spark, fact_path))


def refresh_monthly_sales(spark: SparkSession, fact_name: str, cube_name: str) -> list[str]:
    """R5 kept up to date: rebuild the months of the fact days that changed since the last refresh.

    Both are catalog tables, the cube partitioned by ``month``. The first refresh builds every month. A
    month whose last fact row has gone is dropped. Returns the months rebuilt.
    """
    first = not spark.catalog.tableExists(cube_name)
    todo = changes.pending(spark, fact_name, cube_name)
    fact = tables.read_daily_fact(spark, fact_name)
    months = sorted({d[:6] for d in todo.days})
    if first:
        commit_partitions(sales.monthly_sales_cube(fact), cube_name, ["month"])
    elif months:
        written = commit_partitions(sales.cube_of_months(fact, months), cube_name, ["month"])
        for month in set(months) - {p["month"] for p in written}:
            drop_partition(spark, cube_name, {"month": month})
    changes.taken_in(spark, fact_name, cube_name, todo.runs)
    return sorted(p["month"] for p in partitions(spark, cube_name)) if first else months


def update_monthly_sales(spark: SparkSession, orders: DataFrame, fact_name: str, cube_name: str, days: Iterable, *,
                         preset: LabelPreset = PACKAGES_DAILY_FACT, tz: str = "UTC") -> list[str]:
    """R4 for each of ``days`` (the report day and days with late or corrected orders), then the refresh of R5."""
    for day in sorted({as_day(d) for d in days}):
        tables.store_daily_fact(sales.daily_order_fact(orders, day, preset=preset, tz=tz), fact_name, day)
    return refresh_monthly_sales(spark, fact_name, cube_name)


def publish_report(spark: SparkSession, report: DataFrame, table_path: str, *, fmt: str = "parquet",
                   report_day=None, jdbc_url: str | None = None, jdbc_table: str | None = None,
                   jdbc_properties: Mapping[str, str] | None = None, jdbc_mode: str = "overwrite") -> None:
    """Store a report rerun-safely and optionally export it over JDBC.

    A daily report replaces the ``date`` partition of ``report_day``, also when it is
    empty (``None``: the whole table is replaced, as for the monthly cube).

    ``jdbc_mode="overwrite"`` rewrites the JDBC table from the whole file table
    (truncate + overwrite), so a rerun never duplicates a day there; a failure in
    between leaves it part filled until the rerun. ``"append"`` adds the rows of this
    report only, what a scheduler that never reruns an exported day wants. ``"swap"`` loads a
    staging table and replaces the report day (or the whole table) from it in one transaction, so
    readers never see a part (``sources.export``). Report tables hold aggregates (groups x
    days), so the full export stays small.
    """
    if report_day is not None and tables.is_catalog_name(table_path):
        tables.replace_table_partition(report, table_path, ("date", date_key(report_day)), fmt=fmt)
    elif tables.is_catalog_name(table_path):
        report.write.format(fmt).mode("overwrite").saveAsTable(table_path)
    elif report_day is not None:
        tables.replace_partition(report, table_path, ("date", date_key(report_day)), fmt=fmt)
    else:
        report.write.format(fmt).mode("overwrite").save(table_path)
    if jdbc_url:
        if not jdbc_table:
            raise ValueError("jdbc_table is required with jdbc_url")
        stored = tables.read_report(spark, table_path, report.columns, fmt=fmt)
        if jdbc_mode == "swap":
            export.staged_export(stored, jdbc_url, jdbc_table, day=report_day, properties=jdbc_properties)
            return
        if jdbc_mode == "append" and report_day is not None:
            stored = stored.where(F.col("date") == date_key(report_day))
        jdbc.jdbc_sink(stored, jdbc_url, jdbc_table, mode=jdbc_mode, properties=jdbc_properties)
