"""New-member reports from a persisted first-seen state: a run reads one day of orders.

An order counts for a report once it is *visible*: its own day and the day its account
was added have both come. Orders whose account is dated later wait in a pending table,
partitioned by the day they become visible, and are merged on that day, so a run never
goes back to the order history:

    rows of the day's orders + pending rows of the day  ->  merge into the state  ->  report

Late data: an order, entitlement or account that arrives after its day was run is merged
by naming its order day in ``order_days`` of a later run; the partitions it touches are
rewritten, also those of keys that turn out to be older. An order taken back is corrected
by ``correct_members``. Reports are those of the orders known at the last run.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import BASELINES, as_day, iso, local_day, on_days_ms, report_days, until_day_ms
from ..functions.presets import PACKAGES, PAID_STATUS, LabelPreset
from ..operators.compare import compare_periods
from ..operators.firststate import FIRST_DAY, StateChange, correct_first_seen, merge_first_seen
from ..session import cut
from ..sources.commits import commit_partitions, drop_partition
from .members import BY_CHANNEL, MEMBER_ORDER_TYPES, label_members, new_members_cube

CARRY = ("channelName", "packageName")
PENDING_TYPES = "account_name string, order_type int, channelName string, packageName string, order_day string"


def member_rows(rights: DataFrame, orders: DataFrame, accounts: DataFrame, *, order_days: Iterable | None = None,
                until=None, preset: LabelPreset = PACKAGES, tz: str = "UTC") -> DataFrame:
    """Distinct (account_name, order_type, channelName, packageName, order_day, visible_day), days as ISO text.

    Of the orders added on ``order_days``, or of all until the day ``until``; both are ranges
    on the raw epoch column, which reach the scan. Orders meet accounts before the entitlements.
    """
    in_time = on_days_ms("order_addtime", order_days, tz) if order_days is not None else until_day_ms("order_addtime", until, tz)
    paid = orders.where(F.col("order_type").isin(list(MEMBER_ORDER_TYPES)) & (F.col("order_status") == PAID_STATUS) & in_time)
    named = (paid.select("order_id", "account_id", "order_type", "package_id", "order_addtime")
             .join(accounts.select("account_id", "account_name", "account_addtime"), "account_id"))
    rows = named.join(rights.select("order_id", "package_provide"), "order_id").select(
        "account_name", "order_type", "package_id", "package_provide",
        local_day("order_addtime", tz=tz).alias("_order"), local_day("account_addtime", tz=tz).alias("_account"))
    labeled = label_members(rows.where("_order is not null and _account is not null"), preset)
    return labeled.select("account_name", F.col("order_type").cast("int").alias("order_type"), *CARRY,
                          F.col("_order").cast("string").alias("order_day"),
                          F.greatest("_order", "_account").cast("string").alias("visible_day")).distinct()


def empty_state(spark: SparkSession, keys: Sequence[str] = BY_CHANNEL) -> DataFrame:
    types = {"order_type": "int"}
    columns = [*keys, *(c for c in CARRY if c not in keys), FIRST_DAY]
    return spark.createDataFrame([], ", ".join(f"{c} {types.get(c, 'string')}" for c in columns))


def merged_state(state: DataFrame, rows: DataFrame, keys: Sequence[str] = BY_CHANNEL) -> StateChange:
    return merge_first_seen(state, rows, keys, "order_day", CARRY, cut=cut)


def applied(state: DataFrame, change: StateChange) -> DataFrame:
    """The whole state after a change, for a state that is not stored."""
    rest = state.where(~F.col(FIRST_DAY).isin(change.days)) if change.days else state
    return rest.unionByName(change.rows)


def state_report(state: DataFrame, report_day, *, baselines: Mapping[str, int] = BASELINES) -> DataFrame:
    """R1/R2 from the state: reads the partitions of the report and baseline days only."""
    days = [iso(d) for d in report_days(report_day, baselines).values()]
    first = state.where(F.col(FIRST_DAY).isin(days)).select(
        "account_name", *CARRY, F.to_date(FIRST_DAY).alias("registtime"))
    return compare_periods(new_members_cube(first), day_col="registtime", report_day=as_day(report_day),
                           keys={"channelName": "channelName", "packageName": "packageName"},
                           metrics={"totalUserCount": ("totalUserCount", "userCount")}, baselines=baselines)


def _stored(spark: SparkSession, name: str, empty: DataFrame) -> DataFrame:
    return spark.table(name) if spark.catalog.tableExists(name) else empty


def _store(change: StateChange, name: str) -> None:
    """Commit the changed partitions; each is dealt over several tasks, as one day may hold most keys."""
    if not change.days:
        return
    spread = change.rows.repartition(F.col(FIRST_DAY), F.pmod(F.xxhash64("account_name"), F.lit(8)))
    written = commit_partitions(spread, name, [FIRST_DAY])
    for day in set(change.days) - {p[FIRST_DAY] for p in written}:      # every key of the day has moved
        drop_partition(change.rows.sparkSession, name, {FIRST_DAY: day})


def update_members(spark: SparkSession, rights: DataFrame, orders: DataFrame, accounts: DataFrame, name: str, day, *,
                   keys: Sequence[str] = BY_CHANNEL, order_days: Iterable | None = None,
                   preset: LabelPreset = PACKAGES, tz: str = "UTC") -> list[str]:
    """Bring the catalog tables ``name`` (state) and ``name_pending`` to ``day``; returns the first days that changed.

    The first run reads the order history until ``day``; a later one the orders of ``order_days``, by
    default of ``day`` alone. Days that were skipped, and days with late data, are to be named there.
    Rerunning a day leaves the same tables. Runs of one state must not overlap.
    """
    day, pending = iso(day), f"{name}_pending"
    first_run = not spark.catalog.tableExists(name)
    days = sorted({iso(d) for d in (order_days or [])} | {day})
    rows = cut(member_rows(rights, orders, accounts, until=day, preset=preset, tz=tz) if first_run else
               member_rows(rights, orders, accounts, order_days=days, preset=preset, tz=tz))
    waiting = _stored(spark, pending, spark.createDataFrame([], f"{PENDING_TYPES}, load_day string, visible_day string"))
    due = waiting.where(F.col("visible_day").isin(days) & (F.col("visible_day") <= day))
    now = rows.where(F.col("visible_day") <= day).drop("visible_day")
    change = merged_state(_stored(spark, name, empty_state(spark, keys)), now.unionByName(due.select(*now.columns)), keys)
    # pending rows first: a run that dies after them merges the same rows again
    commit_partitions(rows.where(F.col("visible_day") > day), pending, ["load_day", "visible_day"], owned=("load_day", day))
    _store(change, name)
    if first_run and not change.days:
        commit_partitions(empty_state(spark, keys), name, [FIRST_DAY])
    return change.days


def correct_members(spark: SparkSession, rights: DataFrame, orders: DataFrame, accounts: DataFrame, name: str, day,
                    wrong: DataFrame, *, keys: Sequence[str] = BY_CHANNEL, preset: LabelPreset = PACKAGES,
                    tz: str = "UTC") -> list[str]:
    """Recompute the state of the accounts in ``wrong`` (account_name) from their orders until ``day``.

    For orders that no longer count (cancelled, refunded) after their day was run; the orders are cut to
    those accounts before the entitlements are touched.
    """
    asked = wrong.select(F.col("account_name").alias("_wrong")).distinct()
    theirs = accounts.join(asked, F.col("account_name").eqNullSafe(F.col("_wrong")), "left_semi")
    rows = member_rows(rights, orders, theirs, until=day, preset=preset, tz=tz).where(F.col("visible_day") <= iso(day))
    rows = cut(rows.drop("visible_day"))
    state = spark.table(name)
    listed = state.join(asked, state["account_name"].eqNullSafe(asked["_wrong"]), "left_semi").select(*keys)
    change = correct_first_seen(state, listed.union(rows.select(*keys)), rows, keys, "order_day", CARRY, cut=cut)
    _store(change, name)
    return change.days
