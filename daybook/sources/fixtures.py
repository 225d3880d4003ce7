"""Report inputs derived from the driver's parquet tables (views V1-V4).

The original reports read a membership database and gzip JSON launcher logs;
the test data is a TPC-H-like star plus an ``events`` table. These functions
re-shape those tables into the report inputs with plain column expressions (no
shuffle), so every query reads the given tables and grows with them. The same
views are written in SQL for the DuckDB oracle (``plans.oracle``).

Derived columns (``k`` = integer field ``k`` of ``events.props``, 0-99):

* V1 membership: accounts <- customer, orders <- orders, rights <- lineitem.
* V2 sales orders <- events (daily) and <- orders (multi-month fact).
* V3/V4 launcher log records <- events, one record per event holding one
  page-stay element and one click element.

When report ``days`` are given, the ``events`` scan gets an OR of
``ts`` ranges, which parquet applies as row-group pruning (``PushedFilters``);
it is implied by the reports' own day filters, so results do not change.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import epoch_millis, epoch_seconds, on_days_ntz, until_day_ntz

# report dates of the fixtures (FIXTURES.md)
MEMBERS_DAY = dt.date(1995, 7, 12)
EVENTS_DAY = dt.date(2024, 1, 30)
# fixture thresholds: the production 20 would empty the small heat map
FIXTURE_MIN_GROUP = 3
FIXTURE_MIN_TITLE = 2

# fixed fixture values (FIXTURES.md)
PROVIDERS = ("iQIYI", "Youku", "BesTV", "bestv:pptv", "mango")
SITES = ("ALI", "IQIYI", "BESTV", "XX")
ACCOUNT_BASE_DAY = dt.date(1995, 5, 19)
MS_PER_DAY = 86_400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str, days: Iterable | None) -> DataFrame:
    """``events`` (optionally only the report days) with ``k`` and epoch columns.

    These are computed once per row; Catalyst keeps a non-cheap expression that
    is used several times in its own projection instead of inlining every use.
    """
    e = table(spark, sf_dir, "events")
    if days is not None:
        e = e.where(on_days_ntz("ts", days))
    return e.select("*", F.expr("try_cast(get_json_object(props, '$.k') AS INT)").alias("k"),
                    epoch_millis("ts").alias("ts_ms"), epoch_seconds("ts").alias("ts_s"))


def _choose(index: str, values: Sequence[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index} {whens} END"


# --------------------------------------------------------------------- V1
def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = (ACCOUNT_BASE_DAY - dt.date(1970, 1, 1)).days
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS account_id",
        "c_name AS account_name",
        f"CAST(({base} + c_custkey % 60) * {MS_PER_DAY} AS BIGINT) AS account_addtime",
    )


def member_orders(spark: SparkSession, sf_dir: str, until: dt.date | None = None) -> DataFrame:
    """``until`` bounds the order day (inclusive) on the stored column, so that the scan prunes."""
    o = table(spark, sf_dir, "orders")
    if until is not None:
        o = o.where(until_day_ntz("o_orderdate", until))
    o = o.select("*", epoch_millis("o_orderdate").alias("date_ms"))
    return o.selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS account_id",
        "CAST(o_orderkey % 3 + 1 AS INT) AS order_type",
        "CASE WHEN o_orderstatus IN ('F', 'O') THEN 4 ELSE 1 END AS order_status",
        "concat('PK', o_orderkey % 24) AS package_id",
        "date_ms AS order_addtime",
    )


def rights(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("*", epoch_millis("l_shipdate").alias("ship_ms"))
    return li.selectExpr(
        "l_orderkey AS order_id",
        f"{_choose('l_partkey % 5', PROVIDERS)} AS package_provide",
        "ship_ms AS right_starttime",
        f"ship_ms + CAST(l_quantity AS BIGINT) * {MS_PER_DAY} AS right_limitdate",
    )


# --------------------------------------------------------------------- V2
def sales_orders(spark: SparkSession, sf_dir: str, days: Iterable | None = None) -> DataFrame:
    """Orders as the sales reports read them, from ``events``."""
    return _events(spark, sf_dir, days).selectExpr(
        "concat('PK', event_id % 24) AS package_id",
        f"{_choose('k % 5', PROVIDERS)} AS order_provide",
        "CAST(round(value * 100) AS BIGINT) AS order_price",
        "CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 WHEN 'view' THEN 3 ELSE 9 END AS order_type",
        "CASE WHEN k % 10 <> 0 THEN 4 ELSE 1 END AS order_status",
        "CASE WHEN k % 9 <> 0 THEN 1 ELSE 0 END AS order_state",
        "ts_ms AS order_delevetime",
    )


def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-month orders for the monthly cube, from ``orders``."""
    o = table(spark, sf_dir, "orders").select("*", epoch_millis("o_orderdate").alias("date_ms"))
    return o.selectExpr(
        "concat('PK', o_orderkey % 24) AS package_id",
        f"{_choose('o_custkey % 5', PROVIDERS)} AS order_provide",
        "CAST(round(o_totalprice * 100) AS BIGINT) AS order_price",
        "CAST(o_orderkey % 3 + 1 AS INT) AS order_type",
        "CASE WHEN o_orderstatus IN ('F', 'O') THEN 4 ELSE 1 END AS order_status",
        "1 AS order_state",
        "date_ms AS order_delevetime",
    )


# ------------------------------------------------------------------ V3/V4
def launcher_logs(spark: SparkSession, sf_dir: str, days: Iterable | None = None) -> DataFrame:
    """Launcher log records (``schemas.LOG_RECORD`` shape), one per event."""
    time = "CASE WHEN k % 13 = 0 THEN NULL ELSE ts_s END"
    page_stay = f"""named_struct(
        'time', {time},
        'enter', ts_s,
        'exit', ts_s + CAST(floor(value * 10) AS BIGINT) - CASE WHEN k % 7 = 0 THEN 600 ELSE 0 END,
        'title', CASE WHEN k % 10 = 9 THEN NULL ELSE event_type END)"""
    click = f"""named_struct(
        'time', {time},
        'category', CASE WHEN k % 23 = 0 THEN NULL ELSE event_type END,
        'position', CASE WHEN k % 10 = 9 THEN 'nav' ELSE concat(floor(k / 50), ',', k % 2) END,
        'title', CASE WHEN k % 19 = 0 THEN NULL ELSE concat('t', k % 8) END,
        'type', event_type)"""
    return _events(spark, sf_dir, days).selectExpr(
        "CASE WHEN k % 17 = 0 THEN NULL ELSE concat('u', user_id) END AS custom_uuid",
        "concat('a', user_id) AS account",
        "ts_ms AS rectime",
        "CAST(100 + k % 3 AS STRING) AS vercode",
        "concat('v1.', k % 3) AS vername",
        "concat('box', user_id % 4) AS device_name",
        f"{_choose('k % 4', SITES)} AS site",
        "'launcher' AS packageName",
        f"named_struct('launcher_page_stay', array({page_stay}), 'home_item_click', array({click})) AS data",
    )
