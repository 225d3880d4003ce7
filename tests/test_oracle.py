"""Every registered query equals its independent DuckDB SQL at sf0.01."""

import pytest

from __spark_entry__ import entry
from conftest import SF
from daybook.plans import catalog, oracle
from daybook.plans.verify import compare

queries = lambda: catalog.QUERIES  # noqa: E731  the report queries; tests/llm has the others
oracle_sql = oracle.all_sql
KEYS = sorted(queries())


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_duckdb(spark, duck, key):
    ok, msg = compare(queries()[key](spark, SF), duck, oracle_sql()[key])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["date", "channelName", "typeName", "id_1"]
    assert len(df.columns) == 19


@pytest.mark.parametrize("key", ["page_exposure_report", "daily_sales_report", "new_members_report",
                                 "click_heatmap_report", "daily_order_fact"])
def test_results_ignore_the_session_time_zone(spark, duck, key):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        ok, msg = compare(queries()[key](spark, SF), duck, oracle_sql()[key])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert ok, msg


def test_oracle_double_format_matches_spark(spark, duck):
    from daybook.plans.oracle import java_double

    values = [0.0, 0.01, -57.14, 25.0, 100.0, 9999999.99, 1e7, 12345678.9, -12345678.91, 99999999.99,
              1e15, 1e16, 1.5e20, 123456789012345680.0, -2.5e300]
    want = [r.s for r in spark.createDataFrame([(v,) for v in values], "x double")
            .selectExpr("cast(x as string) s").collect()]
    rows_ = ", ".join(f"({i}, CAST({v!r} AS DOUBLE))" for i, v in enumerate(values))
    got = [r[0] for r in duck.execute(
        f"SELECT {java_double('x')} FROM (VALUES {rows_}) t(i, x) ORDER BY i").fetchall()]
    assert got == want


@pytest.mark.parametrize("key", ["page_exposure_report", "new_members_report", "click_heatmap_report",
                                 "monthly_sales_cube"])
def test_results_do_not_depend_on_ansi_mode(spark, duck, key):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        ok, msg = compare(queries()[key](spark, SF), duck, oracle_sql()[key])
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    assert ok, msg
