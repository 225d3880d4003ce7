"""The single-pass rewrites equal the per-day reference shapes."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF, rows
from daybook.functions.dates import report_days
from daybook.functions.presets import fixture_packages
from daybook.operators.cohort import first_seen
from daybook.operators.compare import compare_frames, compare_periods
from daybook.plans import catalog, exposure, members
from daybook.plans.exposure import EXPOSURE_METRICS
from daybook.sources import fixtures as fx


def _labeled(spark):
    return members.label_members(catalog._pull(spark, SF), fixture_packages())


def _empty_both_ways(a, b):
    assert a.exceptAll(b).count() == 0
    assert b.exceptAll(a).count() == 0


def test_first_seen_aggregate_equals_window(spark):
    labeled = _labeled(spark)
    days = list(report_days(fx.MEMBERS_DAY).values())
    for keys in (members.BY_CHANNEL, members.BY_ACCOUNT):
        agg = first_seen(labeled, keys, "order_addtime", days)
        tagged = (labeled.where(F.col("order_addtime") <= F.lit(days[0]))
                  .withColumn("registtime", F.min("order_addtime").over(Window.partitionBy(*keys))))
        win = tagged.where((F.col("order_addtime") == F.col("registtime")) & F.col("registtime").isin(days))
        assert agg.columns == win.columns
        _empty_both_ways(agg, win)


def test_cohorts_need_only_the_history_of_report_day_accounts(spark):
    days = list(report_days(fx.MEMBERS_DAY).values())
    whole = members.label_members(catalog._pull(spark, SF), fixture_packages())
    part = members.label_members(catalog._pull(spark, SF, cohort=True), fixture_packages())
    assert 0 < part.count() < whole.count()
    for keys in (members.BY_CHANNEL, members.BY_ACCOUNT):
        _empty_both_ways(first_seen(part, keys, "order_addtime", days), first_seen(whole, keys, "order_addtime", days))


def test_first_seen_equals_per_day_reference_form(spark):
    """Reference: per day d, rows <= d, min over keys, keep min = d."""
    labeled = _labeled(spark)
    labeled.createOrReplaceTempView("labeled_members")
    d0 = fx.MEMBERS_DAY
    for keys in (members.BY_CHANNEL, members.BY_ACCOUNT):
        got = members.new_members(labeled, d0, keys=keys)
        parts = []
        for d in report_days(d0).values():
            parts.append(f"""
              SELECT account_name, order_type, channelName, package, packageName, right_starttime,
                     right_limittime, first_day AS registtime
              FROM (SELECT *, min(order_addtime) OVER (PARTITION BY {', '.join(keys)}) AS first_day
                    FROM labeled_members WHERE order_addtime <= DATE'{d}') t
              WHERE first_day = DATE'{d}'""")
        want = spark.sql(" UNION ALL ".join(parts))
        _empty_both_ways(got.select(*want.columns), want)


def test_cohort_definitions_differ(spark):
    labeled = _labeled(spark)
    by_channel = members.new_members(labeled, fx.MEMBERS_DAY, keys=members.BY_CHANNEL)
    by_account = members.new_members(labeled, fx.MEMBERS_DAY, keys=members.BY_ACCOUNT)
    assert by_channel.count() > by_account.count() > 0


def test_pivot_compare_equals_join_compare(spark):
    days = report_days(fx.EVENTS_DAY)
    stays = exposure.page_stay_rows(fx.launcher_logs(spark, SF, days.values()))
    cube = exposure.exposure_cube(stays, days.values())
    keys = {"site": "channelName", "title": "typeName"}
    pivot = compare_periods(cube, day_col="dt", report_day=fx.EVENTS_DAY, keys=keys,
                            metrics=EXPOSURE_METRICS, day_value=str)
    per_day = {s: exposure.exposure_cube(stays, [d]).drop("dt") for s, d in days.items()}
    joined = compare_frames(per_day[""], {"Day": per_day["Day"], "Week": per_day["Week"]},
                            report_day=fx.EVENTS_DAY, keys=keys, metrics=EXPOSURE_METRICS)
    assert pivot.columns == joined.columns
    assert rows(pivot) == rows(joined)
    assert pivot.count() == 33


def test_single_pass_heatmap_equals_joined_form(spark):
    from daybook.plans import heatmap

    days = report_days(fx.EVENTS_DAY)
    clicks = heatmap.click_rows(fx.launcher_logs(spark, SF, days.values()))
    for args in (dict(min_count=fx.FIXTURE_MIN_GROUP, title_min_count=fx.FIXTURE_MIN_TITLE),
                 dict(min_count=2, title_min_count=5, k=2, sep="| ")):
        want = heatmap.click_heatmap_report_one_pass(clicks, fx.EVENTS_DAY, **args)
        got = heatmap.click_heatmap_report(clicks, fx.EVENTS_DAY, **args)
        assert got.columns == want.columns
        assert rows(got) == rows(want) and got.count() > 0
