"""Property tests: operators against brute force on random small inputs
(NULL keys, duplicates, ties, missing days)."""

import collections
import datetime as dt
import itertools

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from daybook.operators.cohort import first_seen
from daybook.operators.compare import compare_frames, compare_periods
from daybook.operators.rollup import rollup
from daybook.operators.topk import top_k_labels

D0 = dt.date(2024, 1, 30)
DAYS = [D0, D0 - dt.timedelta(days=1), D0 - dt.timedelta(days=7)]
ALL_DAYS = DAYS + [D0 - dt.timedelta(days=3), D0 + dt.timedelta(days=1)]

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
key = st.sampled_from(["a", "b", "123", None])
value = st.integers(min_value=0, max_value=5)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(ALL_DAYS), key, key, value), min_size=1, max_size=30))
def test_rollup_and_pivot_match_brute_force(spark, data):
    df = spark.createDataFrame(data, "day date, k1 string, k2 string, v long")
    cube = rollup(df, ["k1", "k2"], [F.sum("v").alias("v"), F.count_distinct("v").alias("n")], always=["day"])
    # brute force cube
    want = collections.defaultdict(list)
    for day, k1, k2, v in data:
        for gid, (m1, m2) in enumerate(itertools.product((k1, None), (k2, None))):
            want[(day, m1, m2, gid)].append(v)
    expected = sorted(((d, a, b, g, sum(vs), len(set(vs))) for (d, a, b, g), vs in want.items()), key=repr)
    assert rows(cube) == expected
    # pivot form equals the join form
    keys = {"k1": "k1", "k2": "k2"}
    metrics = {"v": ("v", "v"), "n": ("n", "n")}
    pivot = compare_periods(cube, day_col="day", report_day=D0, keys=keys, metrics=metrics)
    per_day = {s: cube.where(F.col("day") == d).drop("day") for s, d in zip(("", "Day", "Week"), DAYS)}
    joined = compare_frames(per_day[""], {"Day": per_day["Day"], "Week": per_day["Week"]},
                            report_day=D0, keys=keys, metrics=metrics)
    assert rows(pivot) == rows(joined)


@SETTINGS
@given(st.lists(st.tuples(key, st.sampled_from(["x", "y"]), st.sampled_from(ALL_DAYS), st.sampled_from("pq")),
                min_size=1, max_size=30))
def test_first_seen_matches_per_day_definition(spark, data):
    df = spark.createDataFrame(data, "acct string, kind string, day date, v string")
    keys = ["acct", "kind"]
    expected = []
    for d in DAYS:   # per report day: rows <= d whose key's minimum is d
        upto = [r for r in data if r[2] <= d]
        first = {}
        for a, k, day, _ in upto:
            first[(a, k)] = min(first.get((a, k), day), day)
        expected += [(a, k, day, v, d) for a, k, day, v in upto if first[(a, k)] == d]
    expected.sort(key=repr)
    assert rows(first_seen(df, keys, "day", DAYS)) == expected


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["g1", "g2", None]), st.sampled_from(["t1", "t2", "t3", "t4", None]),
                          st.sampled_from(["u1", "u2", None])), min_size=1, max_size=40),
       st.integers(min_value=1, max_value=3), st.integers(min_value=1, max_value=3))
def test_top_k_matches_brute_force(spark, data, k, min_count):
    df = spark.createDataFrame(data, "g string, t string, u string")
    got = rows(top_k_labels(df, ["g"], "t", count_of="u", k=k, min_count=min_count, out_col="s"))
    counts = collections.Counter((g, t) for g, t, u in data if t is not None and u is not None)
    groups = {g for g, t, _ in data if t is not None}
    expected = []
    for g in groups:
        ranked = sorted(((t, n) for (gg, t), n in counts.items() if gg == g and n >= min_count),
                        key=lambda x: (-x[1], x[0]))
        if ranked:
            expected.append((g, "|".join(t for t, _ in ranked[:k])))
    assert got == sorted(expected, key=repr)


@SETTINGS
@given(st.lists(st.tuples(key, st.sampled_from(["x", "y", None]), st.sampled_from(ALL_DAYS),
                          st.sampled_from(["p", "q", None])), min_size=1, max_size=30))
def test_first_seen_groups_equal_distinct_first_seen_rows(spark, data):
    from daybook.operators.cohort import first_seen_groups

    df = spark.createDataFrame(data, "acct string, kind string, day date, v string")
    for keys in (["acct", "kind"], ["acct"]):
        carry = ["acct", "kind", "v"]
        got = first_seen_groups(df, keys, "day", DAYS, carry=carry)
        want = first_seen(df, keys, "day", DAYS).select(*keys, *[c for c in carry if c not in keys],
                                                        "registtime").distinct()
        assert got.columns == want.columns
        assert rows(got) == rows(want)


def _half_up(x, nd=2):
    from decimal import ROUND_HALF_UP, Decimal
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-nd), rounding=ROUND_HALF_UP))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.sampled_from(["x", None]),
                          st.sampled_from(["u1", "u2", "u3", None]),
                          st.integers(min_value=-100, max_value=2000)), min_size=1, max_size=25))
def test_exposure_cube_matches_brute_force(spark, data):
    from daybook.plans.exposure import exposure_cube

    rows_in = [("2024-01-30", s, t, u, secs) for s, t, u, secs in data]
    df = spark.createDataFrame(rows_in, "dt string, site string, title string, custom_uuid string, "
                                        "staySeconds long")
    got = {(r.site, r.title, r.id_1): (r.playNum, r.playTime, r.users, r.avgPlayNum, r.avgPlayTime)
           for r in exposure_cube(df, [D0]).collect()}
    groups = collections.defaultdict(list)
    for s, t, u, secs in data:
        if 0 <= secs <= 1800:
            for gid, (ms, mt) in enumerate(itertools.product((s, None), (t, None))):
                groups[(ms, mt, gid)].append((u, secs))
    want = {}
    for g, items in groups.items():
        plays = sum(1 for u, _ in items if u is not None)
        users = len({u for u, _ in items if u is not None})
        secs = sum(s for _, s in items)
        want[g] = (plays, _half_up(secs / 3600), users,
                   _half_up(plays / users) if users else None,
                   _half_up(secs / users / 60) if users else None)
    assert got == want


@SETTINGS
@given(st.lists(st.sampled_from(["IQIYI", "iqiyi", "Youku", "BESTV", "bestv:PPTV", "mango", "", None]),
                min_size=1, max_size=20))
def test_provider_labels_match_a_dictionary(spark, codes):
    from daybook.functions.labels import label_map
    from daybook.functions.presets import PROVIDER_CHANNELS

    lookup = {code: label for label, cs in PROVIDER_CHANNELS.pairs for code in cs}
    want = [lookup.get(c.lower(), "others") if c is not None else "others" for c in codes]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i int, p string")
    got = [r[1] for r in sorted(df.select("i", label_map("p", PROVIDER_CHANNELS)).collect())]
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["2024-01-30", "2024-01-29", "2024-01-23", "2024-01-25"]),
                          st.sampled_from(["a", "b"]), st.sampled_from(["c1", None]),
                          st.sampled_from(["0,1", "1,1", "nav", None]),
                          st.sampled_from(["t1", "t2", "t3", None]), st.sampled_from(["u1", "u2", None])),
                min_size=1, max_size=40),
       st.integers(min_value=1, max_value=3), st.integers(min_value=1, max_value=3),
       st.integers(min_value=1, max_value=3))
def test_single_pass_heatmap_equals_joined_form_on_random_clicks(spark, data, min_count, title_min, k):
    from daybook.plans import heatmap

    clicks = spark.createDataFrame(
        [(u, s, c, p, t, d) for d, s, c, p, t, u in data],
        "custom_uuid string, site string, category string, position string, title string, dt string")
    args = dict(min_count=min_count, title_min_count=title_min, k=k)
    want = heatmap.click_heatmap_report_one_pass(clicks, D0, **args)
    got = heatmap.click_heatmap_report(clicks, D0, **args)
    assert got.columns == want.columns
    assert rows(got) == rows(want)
