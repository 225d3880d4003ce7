"""The persisted first-seen state equals the full recomputation, day after day, with late and corrected data."""

import datetime as dt
import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from daybook.functions.dates import iso
from daybook.functions.presets import ANNUAL, GIFT, MONTHLY, fixture_packages
from daybook.operators.firststate import FIRST_DAY, merge_first_seen, state_rows
from daybook.plans import members, memberstate
from daybook.session import cut

START = dt.date(2024, 2, 20)          # a leap day and a month end lie within
MS = 86_400_000
PROVIDERS = {"iQIYI": "iqiyi", "BesTV": "bestv", "bestv:pptv": "bestv", "mango": "others"}
PACKAGES = {"PK0": ANNUAL, "PK1": ANNUAL, "PK13": MONTHLY, "PK23": None}


def ms(day: dt.date, at: int = 3_600_000) -> int:
    return (day - dt.date(1970, 1, 1)).days * MS + at


class World:
    """Tables that grow by the day; ``late`` maps a day to the order days that must be read again on it."""

    def __init__(self, seed: int, days: int):
        rng, self.late = random.Random(seed), {}
        self.accounts, self.orders, self.rights = [], [], []      # (day known, row)
        for a in range(60):
            added = START + dt.timedelta(days=rng.randrange(-5, 1) if rng.random() < 0.7 else rng.randrange(days))
            # two ids share a name; some accounts are dated after their first orders
            self.accounts.append((START if rng.random() < 0.8 else added, (a, f"n{a % 55}" if a else None, ms(added))))
        for o in range(days * 6):
            day = START + dt.timedelta(days=rng.randrange(-4, days))
            known = max(START, day + dt.timedelta(days=rng.choice([0, 0, 0, 0, 3, 6])))
            account = 1 if rng.random() < 0.3 else rng.randrange(61)
            provider, package = rng.choice(list(PROVIDERS)), rng.choice(list(PACKAGES))
            status = 4 if rng.random() < 0.9 else 1
            self.orders.append((known, (o, account, rng.choice([1, 2, 2, 3]), status, package, ms(day, rng.randrange(MS)))))
            for _ in range(rng.choice([1, 1, 2])):
                right = max(known, day + dt.timedelta(days=rng.choice([0, 0, 0, 5])))
                self.rights.append((right, (o, rng.choice([provider, "Youku2"]), 1, 2)))
        known_account = {row[0]: known for known, row in self.accounts}
        seen_right = {}
        for right, row in self.rights:
            seen_right.setdefault(row[0], set()).add(right)
        for known, row in self.orders:
            day = dt.date(1970, 1, 1) + dt.timedelta(days=row[5] // MS)
            for at in {known, *seen_right[row[0]], known_account.get(row[1], known)}:
                self.late.setdefault(max(at, known), set()).add(day)

    def tables(self, spark, day):
        pick = lambda items: [row for known, row in items if known <= day]
        return (spark.createDataFrame(pick(self.rights), "order_id long, package_provide string, right_starttime long, right_limitdate long"),
                spark.createDataFrame(pick(self.orders), "order_id long, account_id long, order_type int, order_status int, "
                                                         "package_id string, order_addtime long"),
                spark.createDataFrame(pick(self.accounts), "account_id long, account_name string, account_addtime long"))

    def brute_force(self, day, by_account=False):
        """The state by plain loops over all rows known on ``day``."""
        names = {row[0]: row for known, row in self.accounts if known <= day and row[2] < ms(day + dt.timedelta(days=1), 0)}
        provided = {}
        for known, row in self.rights:
            if known <= day:
                provided.setdefault(row[0], set()).add(row[1])
        first = {}
        for known, (o, account, kind, status, package, at) in self.orders:
            if known > day or kind == 3 or status != 4 or account not in names or at >= ms(day + dt.timedelta(days=1), 0):
                continue
            on = iso(dt.date(1970, 1, 1) + dt.timedelta(days=at // MS))
            for provider in provided.get(o, ()):
                channel = PROVIDERS.get(provider, "others")
                label = GIFT if kind == 1 else PACKAGES[package]
                name = names[account][1]
                key, extra = ((name,), (channel, label)) if by_account else ((name, kind, channel), (label,))
                first.setdefault(key, {}).setdefault(on, set()).add(extra)
        return sorted(((*key, *extra, min(days)) for key, days in first.items() for extra in days[min(days)]), key=repr)


@pytest.fixture
def name(spark):
    drop = lambda: [spark.sql(f"DROP TABLE IF EXISTS {t}") for t in ("member_first", "member_first_pending")]
    drop()
    yield "member_first"
    drop()


def stored(spark, name, keys=members.BY_CHANNEL):
    return rows(spark.table(name).select(*keys, *(c for c in memberstate.CARRY if c not in keys), FIRST_DAY))


def test_thirty_days_equal_the_full_recomputation(spark, name):
    world = World(seed=11, days=30)
    touched_late, reported = 0, 0
    for n in range(30):
        day = START + dt.timedelta(days=n)
        tables = world.tables(spark, day)
        again = [d for d in world.late.get(day, ()) if d <= day]
        changed = memberstate.update_members(spark, *tables, name, day, order_days=again, preset=fixture_packages())
        touched_late += bool(set(changed) - {iso(day)})
        want = world.brute_force(day)
        assert stored(spark, name) == want, day
        if n > 1 and reported < 3 and any(first[-1] == iso(day) for first in want):
            report = rows(members.new_members_report(*tables, day, preset=fixture_packages()))
            assert rows(memberstate.state_report(spark.table(name), day)) == report != []
            reported += 1
    assert touched_late > 5 and reported == 3
    # a rerun changes nothing
    memberstate.update_members(spark, *tables, name, day, order_days=again, preset=fixture_packages())
    assert stored(spark, name) == world.brute_force(day)


def test_by_account_skipped_days_and_cancelled_orders(spark, name):
    world, keys = World(seed=5, days=9), members.BY_ACCOUNT
    for n in (0, 3, 4):
        day = START + dt.timedelta(days=n)
        again = {d for k in range(n + 1) for d in world.late.get(START + dt.timedelta(days=k), ())} | {
            START + dt.timedelta(days=k) for k in range(n + 1)}
        memberstate.update_members(spark, *world.tables(spark, day), name, day, keys=keys, preset=fixture_packages(),
                                   order_days=[d for d in again if d <= day])
        assert stored(spark, name, keys) == world.brute_force(day, by_account=True)
    # a third of the orders is taken back: first days move on, or go
    gone = {k for k in range(len(world.orders)) if k % 3 == 0}
    wrong = {world.orders[k][1][1] for k in gone}
    world.orders = [(known, (*row[:3], 1, *row[4:]) if k in gone else row) for k, (known, row) in enumerate(world.orders)]
    listed = spark.createDataFrame([(row[1],) for _, row in world.accounts if row[0] in wrong], "account_name string")
    changed = memberstate.correct_members(spark, *world.tables(spark, day), name, day, listed, keys=keys,
                                          preset=fixture_packages())
    assert changed and stored(spark, name, keys) == world.brute_force(day, by_account=True)


def test_a_run_that_fails_leaves_the_state(spark, name, monkeypatch):
    world, day = World(seed=3, days=4), START
    memberstate.update_members(spark, *world.tables(spark, day), name, day, preset=fixture_packages())
    before = stored(spark, name)
    monkeypatch.setattr(memberstate, "_store", lambda change, name: (_ for _ in ()).throw(RuntimeError("driver lost")))
    later = START + dt.timedelta(days=2)
    days = [START + dt.timedelta(days=k) for k in range(-4, 3)]
    with pytest.raises(RuntimeError):
        memberstate.update_members(spark, *world.tables(spark, later), name, later, order_days=days, preset=fixture_packages())
    assert stored(spark, name) == before
    monkeypatch.undo()
    memberstate.update_members(spark, *world.tables(spark, later), name, later, order_days=days, preset=fixture_packages())
    assert stored(spark, name) == world.brute_force(later)


def test_merge_is_idempotent_and_order_free_also_with_a_hot_key(spark):
    rng = random.Random(1)
    data = [("hot" if k % 3 == 0 else f"k{rng.randrange(40)}" if k % 7 else None, rng.choice("ab"), f"2024-01-{rng.randrange(1, 29):02}")
            for k in range(600)]
    df = spark.createDataFrame(data, "key string, label string, day string")
    want = rows(state_rows(df, ["key"], "day", ["label"]))
    state = spark.createDataFrame([], "key string, label string, first_day string")
    cuts = [df.where(F.col("day") > "2024-01-20"), df.where(F.col("day") <= "2024-01-10"), df.where("label = 'a'"), df, df]
    for part in cuts:
        state = cut(memberstate.applied(state, merge_first_seen(state, part, ["key"], "day", ["label"], cut=cut)))
    assert rows(state) == want
    nothing = merge_first_seen(state, df.where("false"), ["key"], "day", ["label"], cut=cut)
    assert nothing.days == [] and nothing.rows.count() == 0


def test_a_run_reads_one_day_of_orders_and_the_report_three_partitions(spark, tmp_path, name):
    world = World(seed=7, days=3)
    for table, df in zip(("rights", "orders", "accounts"), world.tables(spark, START + dt.timedelta(days=3)), strict=True):
        df.write.parquet(str(tmp_path / table))
    read = [spark.read.parquet(str(tmp_path / t)) for t in ("rights", "orders", "accounts")]
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        plan = memberstate.member_rows(*read, order_days=[START])._jdf.queryExecution().executedPlan().toString()
        assert f"GreaterThanOrEqual(order_addtime,{ms(START, 0)})" in plan and f"LessThan(order_addtime,{ms(START, MS)})" in plan
        memberstate.update_members(spark, *read, name, START + dt.timedelta(days=2), preset=fixture_packages())
        report = memberstate.state_report(spark.table(name), START + dt.timedelta(days=2))
        plan = report._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert re.search(r"PartitionFilters: \[first_day#\d+ IN", plan)
    assert "order_addtime" not in plan and "Window" not in plan
