"""Counts probed independently in FIXTURES.md at sf0.01 (report day, day-1, day-7)."""

from pyspark.sql import functions as F

from conftest import SF
from daybook.plans import catalog


def per_day(df, day_col, *cols):
    agg = F.countDistinct(*cols) if cols else F.count("*")
    return {str(r[0]): r[1] for r in df.groupBy(day_col).agg(agg).collect()}


def test_first_seen_cohort_sizes(spark):
    by_channel = catalog.first_seen_by_channel(spark, SF)
    keys = ("account_name", "order_type", "channelName")
    assert per_day(by_channel, "registtime", *keys) == {"1995-07-12": 17, "1995-07-11": 16, "1995-07-05": 6}
    by_account = catalog.first_seen_by_account(spark, SF)
    assert per_day(by_account, "registtime", *keys) == {"1995-07-12": 8, "1995-07-11": 11, "1995-07-05": 4}


def test_paid_sales_rows_per_day(spark):
    cube = catalog.daily_sales_cube(spark, SF).where("id_1 = 3")
    assert {str(r.day): r.sellCount for r in cube.collect()} == {
        "2024-01-30": 98, "2024-01-29": 124, "2024-01-23": 125}


def test_heatmap_rows_per_day(spark):
    gs = catalog.click_grouping_sets(spark, SF)
    assert per_day(gs.where("id_1 = 0"), "dt") == {"2024-01-30": 40, "2024-01-29": 40, "2024-01-23": 42}
    assert per_day(gs.where("id_1 = 1"), "dt") == {"2024-01-30": 22, "2024-01-29": 22, "2024-01-23": 22}


def test_exposure_report_rows(spark):
    assert catalog.page_exposure_report(spark, SF).count() == 33
