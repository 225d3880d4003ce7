"""New-member reports: first-seen cohorts per channel x order type (R1) and per
account (R2), cubed by channel x package and compared with the previous day/week."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import BASELINES, as_day, local_day, on_days_ms, report_days, until_day_ms
from ..functions.labels import label_map, override
from ..functions.presets import GIFT, ORDER_TYPE_GIFT, PACKAGES, PAID_STATUS, PROVIDER_CHANNELS, LabelPreset
from ..operators.cohort import first_seen, first_seen_groups
from ..operators.compare import compare_periods
from ..operators.rollup import rollup

BY_CHANNEL = ("account_name", "order_type", "channelName")  # new to the channel and order type
BY_ACCOUNT = ("account_name",)                              # new to the service
MEMBER_ORDER_TYPES = (1, 2)                                 # gift and purchase


def member_pull(rights: DataFrame, orders: DataFrame, accounts: DataFrame, report_day, *,
                tz: str = "UTC", with_right_days: bool = True, active_on: Iterable | None = None) -> DataFrame:
    """Distinct member orders up to ``report_day``.

    right ⋈ order on order_id ⋈ account on account_id; paid gift/purchase
    orders added on or before the day, accounts created on or before the day.
    Day bounds are ranges on the raw epoch columns (pushed to the scans); the
    times are returned as local DATEs. ``with_right_days=False`` drops the
    entitlement start/end days before the DISTINCT (the cohort reports do not
    read them, and Catalyst cannot prune grouping columns of a DISTINCT).

    ``active_on``: only the history of accounts with an order on one of these days.
    First-seen cohorts need no other: an account new on a day ordered on that day. The
    orders are cut to them by account name (the cohort key) before the entitlements are
    touched, so the largest shuffle follows the report days and not the whole history.

    Join order: orders ⋈ accounts first, then the (largest) entitlement table,
    so only the order-sized intermediate is re-shuffled, never a rights-sized
    one. Both joins are equi-joins; AQE broadcasts a side only when its measured
    size is under the threshold and splits skewed partitions otherwise.
    """
    d0 = as_day(report_day)
    o = orders.where(F.col("order_type").isin(list(MEMBER_ORDER_TYPES))
                     & (F.col("order_status") == PAID_STATUS)
                     & until_day_ms("order_addtime", d0, tz))
    a = accounts.where(until_day_ms("account_addtime", d0, tz)).select("account_id", "account_name")
    member_orders = (o.select("order_id", "account_id", "order_type", "package_id", "order_addtime")
                     .join(a, "account_id"))
    if active_on is not None:
        active = (member_orders.where(on_days_ms("order_addtime", active_on, tz))
                  .select(F.col("account_name").alias("_active")).distinct())
        member_orders = member_orders.join(active, F.col("account_name").eqNullSafe(F.col("_active")), "left_semi")
    joined = member_orders.join(rights, "order_id")
    cols = [F.col("account_name"), F.col("order_type"), F.col("package_id"), F.col("package_provide")]
    if with_right_days:
        cols += [local_day("right_starttime", tz=tz).alias("right_starttime"),
                 local_day("right_limitdate", tz=tz).alias("right_limittime")]
    cols.append(local_day("order_addtime", tz=tz).alias("order_addtime"))
    return joined.select(*cols).distinct()


def label_members(pull: DataFrame, preset: LabelPreset = PACKAGES) -> DataFrame:
    """Channel and package labels (C1: P1, P3, P5). Rows are not de-duplicated again."""
    package = label_map("package_id", preset)
    rest = [c for c in pull.columns if c not in ("account_name", "order_type", "package_id", "package_provide")]
    return pull.select(
        "account_name", "order_type",
        label_map("package_provide", PROVIDER_CHANNELS).alias("channelName"),
        package.alias("package"),
        override(package, F.col("order_type") == ORDER_TYPE_GIFT, GIFT).alias("packageName"),
        *rest,
    )


def new_members(labeled: DataFrame, report_day, *, keys: Sequence[str] = BY_CHANNEL,
                baselines: Mapping[str, int] = BASELINES) -> DataFrame:
    """Rows first seen (per ``keys``) on the report day or a baseline day (C2: W1/W2)."""
    days = list(report_days(report_day, baselines).values())
    rows = first_seen(labeled, keys, "order_addtime", days)
    return rows.drop("order_addtime")


def new_member_groups(labeled: DataFrame, report_day, *, keys: Sequence[str] = BY_CHANNEL,
                      baselines: Mapping[str, int] = BASELINES) -> DataFrame:
    """Distinct (account, channel, package, registtime) of new members: the input of the cube."""
    days = list(report_days(report_day, baselines).values())
    return first_seen_groups(labeled, keys, "order_addtime", days,
                             carry=["account_name", "channelName", "packageName"])


def new_members_cube(first: DataFrame) -> DataFrame:
    """``GROUP BY registtime, CUBE(channelName, packageName)`` of distinct accounts (A2)."""
    return rollup(first, ["channelName", "packageName"],
                  [F.count_distinct("account_name").alias("totalUserCount")], always=["registtime"])


def new_members_report(rights: DataFrame, orders: DataFrame, accounts: DataFrame, report_day, *,
                       keys: Sequence[str] = BY_CHANNEL, preset: LabelPreset = PACKAGES,
                       tz: str = "UTC", baselines: Mapping[str, int] = BASELINES) -> DataFrame:
    """R1 (``keys=BY_CHANNEL``) / R2 (``keys=BY_ACCOUNT``)."""
    pull = member_pull(rights, orders, accounts, report_day, tz=tz, with_right_days=False,
                       active_on=report_days(report_day, baselines).values())
    first = new_member_groups(label_members(pull, preset), report_day, keys=keys, baselines=baselines)
    return compare_periods(new_members_cube(first), day_col="registtime", report_day=as_day(report_day),
                           keys={"channelName": "channelName", "packageName": "packageName"},
                           metrics={"totalUserCount": ("totalUserCount", "userCount")},
                           baselines=baselines)
