"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query runs one report operator over the whole test tables (through the
views of ``sources.fixtures``) for the fixture report dates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import DAY, date_key, iso, report_days
from ..functions.presets import fixture_fact_packages, fixture_packages
from ..operators.distinct import empty_codes, new_codes
from ..operators.firststate import state_rows
from ..session import cut
from ..sources import fixtures as fx
from . import audience, exposure, heatmap, launcher, members, memberstate, sales

Query = Callable[[SparkSession, str], DataFrame]


def _event_days():
    return list(report_days(fx.EVENTS_DAY).values())


# ------------------------------------------------------------- exposure (V3)
def page_stay_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exposure.page_stay_rows(fx.launcher_logs(spark, sf_dir))


def page_exposure_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _event_days()
    stays = exposure.page_stay_rows(fx.launcher_logs(spark, sf_dir, days))
    return exposure.exposure_cube(stays, days)


def page_exposure_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    stays = exposure.page_stay_rows(fx.launcher_logs(spark, sf_dir, _event_days()))
    return exposure.page_exposure_report(stays, fx.EVENTS_DAY)


# ------------------------------------------------- stored audiences (V3)
def _audience(spark: SparkSession, sf_dir: str, days) -> DataFrame:
    """The audiences of the days, as a load would store them, with a dictionary of their users."""
    stays = exposure.page_stay_rows(fx.launcher_logs(spark, sf_dir, days)).where(F.col("dt").isin([iso(d) for d in days]))
    codes = cut(new_codes(stays, audience.USER, empty_codes(stays, audience.USER)))
    return cut(audience.audience_rows(stays, codes))


def page_audience_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audience.exposure_cube(_audience(spark, sf_dir, _event_days()), _event_days())


def page_audience_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audience.exposure_report(_audience(spark, sf_dir, _event_days()), fx.EVENTS_DAY)


def weekly_exposure_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = [fx.EVENTS_DAY - n * DAY for n in range(14)]
    return audience.weekly_exposure_report(_audience(spark, sf_dir, days), fx.EVENTS_DAY)


# ---------------------------------------------------------------- sales (V2)
def daily_order_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.sales_orders(spark, sf_dir, [fx.EVENTS_DAY])
    return sales.daily_order_fact(orders, fx.EVENTS_DAY, preset=fixture_fact_packages())


def daily_sales_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _event_days()
    return sales.daily_sales_cube(fx.sales_orders(spark, sf_dir, days), days, preset=fixture_packages())


def daily_sales_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.sales_orders(spark, sf_dir, _event_days())
    return sales.daily_sales_report(orders, fx.EVENTS_DAY, preset=fixture_packages())


def monthly_sales_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = sales.daily_order_fact(fx.fact_orders(spark, sf_dir), None, preset=fixture_packages())
    return sales.monthly_sales_cube(fact)


def monthly_sales_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cube of a fact that lacked orders of some days, after those days were corrected and their months refreshed."""
    fact = sales.daily_order_fact(fx.fact_orders(spark, sf_dir), None, preset=fixture_packages())
    changed = [fx.MEMBERS_DAY - n * DAY for n in (0, 1, 40)]
    before = fact.where(~F.col("date").isin([str(date_key(d)) for d in changed]) | (F.col("channelName") == "iqiyi"))
    stored = cut(sales.monthly_sales_cube(before))
    return sales.refreshed_cube(stored, fact, {str(date_key(d))[:6] for d in changed})


# ----------------------------------------------------------- membership (V1)
def _pull(spark: SparkSession, sf_dir: str, with_right_days: bool = True, cohort: bool = False) -> DataFrame:
    return members.member_pull(fx.rights(spark, sf_dir), fx.member_orders(spark, sf_dir, fx.MEMBERS_DAY),
                               fx.accounts(spark, sf_dir), fx.MEMBERS_DAY,
                               with_right_days=with_right_days,
                               active_on=report_days(fx.MEMBERS_DAY).values() if cohort else None)


def member_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pull(spark, sf_dir)


def channel_package_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return members.label_members(_pull(spark, sf_dir), fixture_packages())


def first_seen_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    labeled = members.label_members(_pull(spark, sf_dir, cohort=True), fixture_packages())
    return members.new_members(labeled, fx.MEMBERS_DAY, keys=members.BY_CHANNEL)


def first_seen_by_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    labeled = members.label_members(_pull(spark, sf_dir, cohort=True), fixture_packages())
    return members.new_members(labeled, fx.MEMBERS_DAY, keys=members.BY_ACCOUNT)


def new_members_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    labeled = members.label_members(_pull(spark, sf_dir, with_right_days=False, cohort=True), fixture_packages())
    return members.new_members_cube(members.new_member_groups(labeled, fx.MEMBERS_DAY, keys=members.BY_CHANNEL))


def _members_report(spark: SparkSession, sf_dir: str, keys) -> DataFrame:
    return members.new_members_report(fx.rights(spark, sf_dir), fx.member_orders(spark, sf_dir, fx.MEMBERS_DAY),
                                      fx.accounts(spark, sf_dir), fx.MEMBERS_DAY, keys=keys,
                                      preset=fixture_packages())


def new_members_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _members_report(spark, sf_dir, members.BY_CHANNEL)


def new_members_report_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _members_report(spark, sf_dir, members.BY_ACCOUNT)


# ------------------------------------------- membership from a state (V1)
def _member_state(spark: SparkSession, sf_dir: str, keys) -> DataFrame:
    """The state of the day before yesterday, then brought to the report day by two daily merges."""
    rows = memberstate.member_rows(fx.rights(spark, sf_dir), fx.member_orders(spark, sf_dir, fx.MEMBERS_DAY),
                                   fx.accounts(spark, sf_dir), until=fx.MEMBERS_DAY, preset=fixture_packages())
    d2, d1, d0 = (iso(fx.MEMBERS_DAY - n * DAY) for n in (2, 1, 0))
    rows = cut(rows.where(F.col("visible_day") <= d0))
    state = cut(state_rows(rows.where(F.col("visible_day") <= d2), keys, "order_day", memberstate.CARRY))
    for day in (d1, d0):
        state = memberstate.applied(state, memberstate.merged_state(state, rows.where(F.col("visible_day") == day), keys))
    return state


def member_first_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _member_state(spark, sf_dir, members.BY_CHANNEL)


def new_members_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return memberstate.state_report(_member_state(spark, sf_dir, members.BY_CHANNEL), fx.MEMBERS_DAY)


def new_members_incremental_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return memberstate.state_report(_member_state(spark, sf_dir, members.BY_ACCOUNT), fx.MEMBERS_DAY)


# ------------------------------------------------- both launcher arrays (V3/V4)
def launcher_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return launcher.launcher_items(fx.launcher_logs(spark, sf_dir))


# ------------------------------------------------------------ heat map (V4)
def _clicks(spark: SparkSession, sf_dir: str, days=None) -> DataFrame:
    return heatmap.click_rows(fx.launcher_logs(spark, sf_dir, days))


def click_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clicks(spark, sf_dir)


def click_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _event_days()
    return heatmap.click_grouping_sets(_clicks(spark, sf_dir, days), days, min_count=fx.FIXTURE_MIN_GROUP)


def top_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heatmap.top_titles(_clicks(spark, sf_dir, [fx.EVENTS_DAY]), fx.EVENTS_DAY,
                              min_count=fx.FIXTURE_MIN_TITLE)


def top_titles_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heatmap.top_titles_set(_clicks(spark, sf_dir, [fx.EVENTS_DAY]), fx.EVENTS_DAY,
                                  min_count=fx.FIXTURE_MIN_TITLE)


def click_heatmap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heatmap.click_heatmap_report(_clicks(spark, sf_dir, _event_days()), fx.EVENTS_DAY,
                                        min_count=fx.FIXTURE_MIN_GROUP,
                                        title_min_count=fx.FIXTURE_MIN_TITLE)


QUERIES: dict[str, Query] = {
    "launcher_items": launcher_items,
    "click_flatten": click_flatten,
    "click_grouping_sets": click_grouping_sets,
    "top_titles": top_titles,
    "top_titles_set": top_titles_set,
    "click_heatmap_report": click_heatmap_report,
    "member_pull": member_pull,
    "channel_package_labels": channel_package_labels,
    "first_seen_by_channel": first_seen_by_channel,
    "first_seen_by_account": first_seen_by_account,
    "new_members_cube": new_members_cube,
    "new_members_report": new_members_report,
    "new_members_report_v2": new_members_report_v2,
    "member_first_state": member_first_state,
    "new_members_incremental": new_members_incremental,
    "new_members_incremental_v2": new_members_incremental_v2,
    "daily_order_fact": daily_order_fact,
    "daily_sales_cube": daily_sales_cube,
    "daily_sales_report": daily_sales_report,
    "monthly_sales_cube": monthly_sales_cube,
    "monthly_sales_refreshed": monthly_sales_refreshed,
    "page_stay_flatten": page_stay_flatten,
    "page_exposure_cube": page_exposure_cube,
    "page_exposure_report": page_exposure_report,
    "page_audience_cube": page_audience_cube,
    "page_audience_report": page_audience_report,
    "weekly_exposure_report": weekly_exposure_report,
}
