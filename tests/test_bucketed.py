"""The member pull on bucketed entitlements: equal rows, and no exchange on the entitlement side."""

import re

import pytest
from conftest import SF, rows

from daybook.functions.dates import report_days
from daybook.functions.presets import fixture_packages
from daybook.plans import members, memberstate
from daybook.sources import bucketed
from daybook.sources import fixtures as fx

NAMES = ("b_rights", "b_orders")


@pytest.fixture(scope="module")
def tables(spark):
    bucketed.store_bucketed(fx.rights(spark, SF), "b_rights", "order_id", 16)
    bucketed.store_bucketed(fx.member_orders(spark, SF), "b_orders", "order_id", 16)
    yield spark.table("b_rights"), spark.table("b_orders"), fx.accounts(spark, SF)
    for name in NAMES:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.fixture
def at_scale(spark):
    """No side is small enough to broadcast, as with the real tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def entitlement_side(df) -> str:
    """The operators above the entitlement scan, up to its join."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    at = next(k for k, line in enumerate(lines) if "FileScan" in line and "b_rights" in line)
    depth, path = re.search(r"\w", lines[at]).start(), []
    for line in reversed(lines[:at]):
        found = re.search(r"\w", line)
        if found and found.start() < depth:
            depth = found.start()
            path.append(line.strip())
            if "Join" in line:
                break
    return "\n".join(path)


def test_no_exchange_on_the_entitlement_side(spark, tables, at_scale):
    day = fx.MEMBERS_DAY
    plans = {
        "pull": members.member_pull(*tables, day),
        "report": members.new_members_report(*tables, day, preset=fixture_packages()),
        "cohort": members.member_pull(*tables, day, active_on=report_days(day).values()),
        "state": memberstate.member_rows(*tables, order_days=[day], preset=fixture_packages()),
    }
    for key, df in plans.items():
        path = entitlement_side(df)
        assert "SortMergeJoin" in path and "Exchange" not in path, (key, path)
    plain = members.member_pull(fx.rights(spark, SF), *tables[1:], day)
    assert plain._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(order_id") == 2


def test_rows_are_those_of_plain_tables(spark, tables, at_scale):
    day = fx.MEMBERS_DAY
    plain = members.new_members_report(fx.rights(spark, SF), fx.member_orders(spark, SF), fx.accounts(spark, SF), day, preset=fixture_packages())
    assert rows(members.new_members_report(*tables, day, preset=fixture_packages())) == rows(plain) != []


def test_each_bucket_is_one_sorted_file_and_a_rewrite_replaces(spark, tables):
    assert bucketed.bucket_spec(spark, "b_rights") == (16, "order_id")
    assert len(tables[0].inputFiles()) == 16
    count = tables[0].count()
    bucketed.store_bucketed(fx.rights(spark, SF), "b_rights", "order_id", 16)
    assert spark.table("b_rights").count() == count
    bucketed.store_bucketed(fx.rights(spark, SF).where("false"), "b_none", "order_id", 4, columns=["order_id", "package_provide"])
    assert spark.table("b_none").columns == ["order_id", "package_provide"] and spark.table("b_none").count() == 0
    spark.sql("DROP TABLE b_none")
