"""Paid-order reports: daily sales cube + comparison (R3), daily order fact (R4),
monthly sales cube over the stored fact (R5)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import BASELINES, as_day, local_day, on_days_ms, report_days
from ..functions.labels import label_map
from ..functions.metrics import cents_to_amount
from ..functions.presets import (
    ACTIVE_STATE, ORDER_TYPE_GIFT, ORDER_TYPE_SINGLE, PACKAGES, PACKAGES_DAILY_FACT, PAID_STATUS,
    PROVIDER_CHANNELS, SINGLE_TITLE, LabelPreset,
)
from ..operators.compare import compare_periods
from ..operators.rollup import rollup

SALES_METRICS = {"sellCount": ("sellCount", "sellCount"), "moneyCount": ("moneyCount", "moneyCount")}


def paid_orders(orders: DataFrame, order_types: Iterable[int], days: Iterable | None = None,
                tz: str = "UTC") -> DataFrame:
    """Paid, valid orders of the given types, delivered on ``days`` (all days if None).

    The day test is a range on the raw epoch column, so it reaches the scan.
    """
    cond = ((F.col("order_status") == PAID_STATUS) & (F.col("order_state") == ACTIVE_STATE)
            & F.col("order_type").isin(list(order_types)))
    if days is not None:
        cond = cond & on_days_ms("order_delevetime", days, tz)
    return orders.where(cond)


def package_name(preset: LabelPreset) -> Column:
    """Package label; unmapped single-title orders become the single-title label."""
    return label_map("package_id", preset,
                     fallback=[(F.col("order_type") == ORDER_TYPE_SINGLE, SINGLE_TITLE)])


def daily_sales_cube(orders: DataFrame, days: Iterable, *, preset: LabelPreset = PACKAGES,
                     tz: str = "UTC") -> DataFrame:
    """``GROUP BY day, CUBE(channelName, packageName)``: order count and revenue (A3).

    Orders are first summed per (day, channel, package), map-side; the cube expands
    those few rows, not every order.
    """
    days = list(days)
    rows = paid_orders(orders, (2, 3), days, tz).select(
        local_day("order_delevetime", tz=tz).alias("day"),
        label_map("order_provide", PROVIDER_CHANNELS).alias("channelName"),
        package_name(preset).alias("packageName"),
        "order_price",
    ).groupBy("day", "channelName", "packageName").agg(F.count(F.lit(1)).alias("_n"),
                                                       F.sum("order_price").alias("_cents"))
    metrics = [F.sum("_n").alias("sellCount"), cents_to_amount(F.sum("_cents")).alias("moneyCount")]
    return rollup(rows, ["channelName", "packageName"], metrics, always=["day"])


def daily_sales_report(orders: DataFrame, report_day, *, preset: LabelPreset = PACKAGES,
                       tz: str = "UTC", baselines: Mapping[str, int] = BASELINES) -> DataFrame:
    """Paid sales per channel x package vs the previous day and week."""
    days = report_days(report_day, baselines)
    cube = daily_sales_cube(orders, days.values(), preset=preset, tz=tz)
    return compare_periods(cube, day_col="day", report_day=as_day(report_day),
                           keys={"channelName": "channelName", "packageName": "packageName"},
                           metrics=SALES_METRICS, baselines=baselines)


def yyyymmdd(day: Column) -> Column:
    """``yyyyMMdd`` string of a DATE column (field arithmetic, zone-free)."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("string")


def daily_order_fact(orders: DataFrame, day=None, *, preset: LabelPreset = PACKAGES_DAILY_FACT,
                     tz: str = "UTC") -> DataFrame:
    """One row per (date, channel, vipType, package) with count and revenue.

    ``day`` None aggregates every delivery day (a backfill of the whole fact).
    vipType is 1 for gift orders and 2 otherwise.
    """
    days = None if day is None else [as_day(day)]
    rows = paid_orders(orders, (1, 2, 3), days, tz)
    return rows.groupBy(
        yyyymmdd(local_day("order_delevetime", tz=tz)).alias("date"),
        label_map("order_provide", PROVIDER_CHANNELS).alias("channelName"),
        F.when(F.col("order_type") == ORDER_TYPE_GIFT, 1).otherwise(2).alias("vipType"),
        package_name(preset).alias("packageName"),
    ).agg(F.count(F.lit(1)).alias("sellCount"),
          cents_to_amount(F.sum("order_price")).alias("moneyCount"))


def monthly_sales_cube(fact: DataFrame) -> DataFrame:
    """``GROUP BY month, CUBE(channelName, vipType, packageName)`` over the day fact.

    Rows without a date are dropped before the cube (the month is never rolled
    up, so half of the cube's grouping sets are never built). The stored
    2-decimal amounts are summed as integer cents: exact whatever the summation
    order, and a plain long sum (a wide DECIMAL sum would aggregate BigDecimals).
    """
    rows = fact.where(F.col("date").isNotNull()).select(
        F.substring("date", 1, 6).alias("month"), "channelName", "vipType", "packageName",
        "sellCount", F.round(F.col("moneyCount") * 100).cast("bigint").alias("_cents"))
    metrics = [F.sum("sellCount").alias("sellCount"),
               cents_to_amount(F.sum("_cents")).alias("moneyCount")]
    return rollup(rows, ["channelName", "vipType", "packageName"], metrics, always=["month"])


def cube_of_months(fact: DataFrame, months: Iterable[str]) -> DataFrame:
    """R5 of some months only; where ``date`` is a partition column, only their partitions are read."""
    return monthly_sales_cube(fact.where(F.substring("date", 1, 6).isin(sorted(months))))


def refreshed_cube(cube: DataFrame, fact: DataFrame, months: Iterable[str]) -> DataFrame:
    """The month cube after ``months`` of the fact have changed: theirs built anew, the others as they are."""
    months = sorted(months)
    return cube.where(~F.col("month").isin(months)).unionByName(cube_of_months(fact, months))
