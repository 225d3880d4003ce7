"""Physical plan assertions."""

import re

import pytest

from conftest import SF
from daybook.plans import catalog

queries = lambda: catalog.QUERIES  # noqa: E731  the report queries; tests/llm has the others


def plan_of(df) -> str:
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString() + "\n" + qe.optimizedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {k: plan_of(q(spark, SF)) for k, q in queries().items()}


def test_no_python_in_any_plan(plans):
    for key, plan in plans.items():
        assert "EvalPython" not in plan, key
        assert "PythonUDF" not in plan, key


def test_report_day_filter_reaches_the_scan(plans):
    for key in ("page_exposure_report", "daily_sales_report", "click_heatmap_report"):
        pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plans[key])
        assert pushed and "GreaterThanOrEqual(ts,2024-01-23" in pushed.group(1), key


def test_column_pruning(plans):
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", plans["daily_sales_report"]).group(1)
    assert "event_type" in schema and "user_id" not in schema


def test_period_comparison_has_no_join(plans):
    # one scan, one cube over all report days, a pivot: no join at all
    for key in ("page_exposure_report", "daily_sales_report"):
        assert "Join" not in plans[key], key
        assert plans[key].count("Expand") >= 1


def test_top_titles_use_window_group_limit(plans):
    assert "WindowGroupLimit" in plans["top_titles"]


def test_first_seen_collapses_history_by_hash_aggregation(plans):
    # a hash aggregate below the window; no set per key, no second pull joined back
    for key in ("first_seen_by_channel", "first_seen_by_account", "new_members_cube", "new_members_report",
                "new_members_report_v2"):
        assert "ObjectHashAggregate" not in plans[key] and "collect_set" not in plans[key], key
        assert "partial_min" in plans[key], key
        executed = plans[key][:plans[key].index("\n\n")] if "\n\n" in plans[key] else plans[key]
        assert sum("l_orderkey" in ln and "FileScan" in ln for ln in executed.splitlines()) == 1, key


def test_heatmap_titles_are_ranked_under_a_group_limit(plans):
    plan = plans["click_heatmap_report"]
    assert "WindowGroupLimit" in plan
    # the distinct user counts expand a click into the two report groupings, not into titles too
    assert all("title" not in ln for ln in plan.splitlines() if "Expand" in ln)


def test_one_scan_per_report_input(plans):
    # all report days come from one scan of the input
    for key in ("page_exposure_report", "daily_sales_report", "page_exposure_cube", "daily_sales_cube",
                "click_grouping_sets"):
        executed = plans[key].split("\n")
        scans = [ln for ln in executed if "FileScan parquet" in ln or "Scan parquet" in ln]
        assert len(scans) == 1, (key, scans)


def test_per_key_aggregations_combine_map_side(plans):
    # a hot key costs one partial row per task before the shuffle, not one row per input row
    assert "partial_min" in plans["first_seen_by_channel"]
    assert "partial_count" in plans["top_titles"]
    for key in ("page_exposure_report", "click_grouping_sets", "new_members_cube"):
        # two-phase distinct: the first exchange is keyed by (group, distinct value)
        assert re.search(r"Exchange hashpartitioning\([^)]*(custom_uuid|account_name)", plans[key]), key


def test_day_filters_reach_the_scan_of_entity_tables(spark, tmp_path):
    """On stored entity tables (raw epoch columns) the report-day tests are pushed ranges."""
    from daybook.plans import members, sales
    from daybook.sources import fixtures as fx

    small = "/root/testdata/sf0.001"
    paths = {}
    for name, df in (("orders", fx.member_orders(spark, small)), ("accounts", fx.accounts(spark, small)),
                     ("rights", fx.rights(spark, small)), ("sales", fx.sales_orders(spark, small))):
        paths[name] = str(tmp_path / name)
        df.write.parquet(paths[name])
    read = lambda n: spark.read.parquet(paths[n])
    def pushed_filters(df):
        old = spark.conf.get("spark.sql.maxMetadataStringLength")
        spark.conf.set("spark.sql.maxMetadataStringLength", "100000")   # untruncated scan metadata
        try:
            return " ".join(ln for ln in plan_of(df).splitlines() if "PushedFilters" in ln)
        finally:
            spark.conf.set("spark.sql.maxMetadataStringLength", old)

    pull = members.member_pull(read("rights"), read("orders"), read("accounts"), fx.MEMBERS_DAY)
    pushed = pushed_filters(pull)
    assert "LessThan(order_addtime," in pushed and "LessThan(account_addtime," in pushed
    report = sales.daily_sales_report(read("sales"), fx.EVENTS_DAY)
    pushed = pushed_filters(report)
    assert "GreaterThanOrEqual(order_delevetime," in pushed and "EqualTo(order_status,4)" in pushed


def test_member_report_shuffles_the_entitlements_once_at_scale(spark):
    """With no broadcast allowed (as at 100 TB): one pull, the entitlement side shuffled once."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        df = queries()["new_members_report"](spark, SF)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    lines = plan.splitlines()
    lineitem_scans = [ln for ln in lines if "FileScan parquet" in ln and "l_orderkey" in ln]
    assert len(lineitem_scans) == 1
    # the entitlements are shuffled by order_id once; no exchange by account_id sits above that join
    assert sum("Exchange hashpartitioning(order_id" in ln for ln in lines) == 2   # both join sides
    # orders and accounts, for the members and once more for the accounts of the report days
    assert sum("Exchange hashpartitioning(account_id" in ln for ln in lines) <= 4
