"""Hand-made edge rows."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from daybook.functions.dates import day_bounds_ms, epoch_millis, local_day, report_days, wall_clock
from daybook.functions.labels import label_map
from daybook.functions.metrics import pct_change, round2
from daybook.functions.presets import PACKAGES, PROVIDER_CHANNELS, SITE_CHANNELS, LabelPreset
from daybook.operators.cohort import first_seen
from daybook.operators.compare import compare_periods
from daybook.operators.flatten import flatten_events
from daybook.operators.rollup import rollup
from daybook.operators.topk import top_k_label_set, top_k_labels
from daybook.plans import exposure, heatmap
from daybook.sources.schemas import LOG_RECORD

D0 = dt.date(2024, 1, 30)
D1 = dt.date(2024, 1, 29)
D7 = dt.date(2024, 1, 23)


def _cube(spark, data):
    df = spark.createDataFrame(data, "day date, k1 string, k2 string, v long")
    return rollup(df, ["k1", "k2"], [F.sum("v").alias("v")], always=["day"])


def test_genuine_null_key_differs_from_rolled_up(spark):
    cube = _cube(spark, [(D0, "a", None, 1), (D0, "a", "x", 2)])
    got = {(r.k1, r.k2, r.id_1): r.v for r in cube.collect()}
    assert got[("a", None, 0)] == 1      # genuine NULL package
    assert got[("a", None, 1)] == 3      # package rolled up
    assert got[(None, None, 3)] == 3


def test_compare_is_null_safe_and_has_no_sentinel(spark):
    # a real key '123' must not match a NULL key (the old coalesce sentinel did)
    cube = _cube(spark, [(D0, "123", "p", 10), (D1, None, "p", 5), (D1, "123", "p", 20)])
    out = compare_periods(cube, day_col="day", report_day=D0, keys={"k1": "k1", "k2": "k2"},
                          metrics={"v": ("v", "v")})
    got = {(r.k1, r.k2, r.id_1): (r.v, r.vCompareDay, r.vCompareWeek) for r in out.collect()}
    assert got[("123", "p", 0)] == (10, "-50.0%", None)
    assert (None, "p", 0) not in got     # only on the baseline day: dropped


def test_pct_change_zero_and_missing_base(spark):
    df = spark.createDataFrame([(3, 0), (3, None), (3, 4), (0, 4), (7, 7)], "c long, b long")
    got = [r[0] for r in df.select(pct_change("c", "b")).collect()]
    assert got == [None, None, "-25.0%", "-100.0%", "0.0%"]


def test_rounding_is_half_up_on_the_decimal_form(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-0.125,), (-0.001,)], "x double")
    assert [r[0] for r in df.select(round2("x")).collect()] == [1.01, 2.68, -0.13, 0.0]
    df = spark.createDataFrame([(2.0, 3.0), (1.0, 3.0)], "c double, b double")
    assert [r[0] for r in df.select(pct_change("c", "b")).collect()] == ["-33.33%", "-66.67%"]


def test_label_maps(spark):
    df = spark.createDataFrame([("IQIYI",), ("Bestv:PPTV",), ("mango",), (None,), ("YouKu",)], "p string")
    got = [r[0] for r in df.select(label_map("p", PROVIDER_CHANNELS)).collect()]
    assert got == ["iqiyi", "bestv", "others", "others", "youku"]
    sites = spark.createDataFrame([("ALI",), ("ali",), ("BESTV",), (None,)], "s string")
    got = [r[0] for r in sites.select(label_map("s", SITE_CHANNELS)).collect()]
    assert got == ["youku", "others", "bestv", "others"]   # exact case
    pk = spark.createDataFrame([("XQLA4E",), ("d3pzre",), ("zzz",)], "p string")
    got = [r[0] for r in pk.select(label_map("p", PACKAGES)).collect()]
    assert got == ["年卡", "连续包月", None]                 # no default


def test_label_fallback_branch(spark):
    preset = LabelPreset((("A", ("x",)),))
    df = spark.createDataFrame([("x", 3), ("y", 3), ("y", 2)], "p string, t int")
    got = [r[0] for r in df.select(label_map("p", preset, fallback=[(F.col("t") == 3, "S")])).collect()]
    assert got == ["A", "S", None]


def _stays(spark, data):
    schema = "dt string, site string, title string, custom_uuid string, staySeconds long"
    return spark.createDataFrame([(*r[:4], None if r[5] is None else int((r[5] - r[4]).total_seconds()))
                                  for r in data], schema)


def test_exposure_stay_limits_and_null_users(spark):
    t = dt.datetime(2024, 1, 30, 10, 0, 0)
    s = dt.timedelta(seconds=1)
    data = [
        ("2024-01-30", "a", "x", "u1", t, t + 1800 * s),   # exactly 30 min: kept
        ("2024-01-30", "a", "x", "u1", t, t + 1801 * s),   # too long: dropped
        ("2024-01-30", "a", "x", "u2", t, t - 5 * s),      # exit < enter: dropped
        ("2024-01-30", "a", "y", None, t, t + 60 * s),     # NULL user: not counted
    ]
    cube = exposure.exposure_cube(_stays(spark, data), [D0])
    got = {(r.site, r.title, r.id_1): r for r in cube.collect()}
    x = got[("a", "x", 0)]
    assert (x.playNum, x.users, x.playTime, x.avgPlayNum, x.avgPlayTime) == (1, 1, 0.5, 1.0, 30.0)
    y = got[("a", "y", 0)]
    assert (y.playNum, y.users, y.avgPlayNum, y.avgPlayTime) == (0, 0, None, None)


def _click_rows(spark, data):
    return spark.createDataFrame(
        data, "custom_uuid string, site string, category string, position string, title string, dt string")


def test_heatmap_having_threshold(spark):
    rows_ = [("u%d" % i, "a", "c", "1,1", "t", "2024-01-30") for i in range(19)]
    rows_ += [("u%d" % i, "a", "c", "1,2", "t", "2024-01-30") for i in range(20)]
    rows_ += [("u0", "a", "c", "nav", "t", "2024-01-30"), ("u0", "a", "c", None, "t", "2024-01-30")]
    gs = heatmap.click_grouping_sets(_click_rows(spark, rows_), [D0], min_count=20)
    got = {(r.position, r.id_1): (r.playNum, r.users) for r in gs.collect()}
    assert got == {("1,2", 0): (20, 20), (None, 1): (39, 20)}   # 19 dropped; nav/NULL not cells


def test_top_titles_ties_and_odd_titles(spark):
    data = [("u", "a", "c", "1,1", t, "2024-01-30")
            for t, n in (("b,2", 3), ("a[1]", 3), ("c", 5), ("d", 1), (None, 9)) for _ in range(n)]
    clicks = _click_rows(spark, data)
    top = heatmap.top_titles(clicks, D0, k=3, min_count=1)
    assert [r.title_set for r in top.collect()] == ["c|a[1]|b,2"]   # tie broken by title, text intact
    top2 = heatmap.top_titles(clicks, D0, k=2, min_count=1, sep="| ")
    assert [r.title_set for r in top2.collect()] == ["c| a[1]"]
    # set variant: the NULL title takes a rank, then is left out
    tset = heatmap.top_titles_set(clicks, D0, k=2, min_count=1)
    assert [r.title_set for r in tset.collect()] == ["c"]


def test_top_k_bounded_per_group(spark):
    df = spark.createDataFrame([("g", f"t{i}", "u") for i in range(50)], "g string, t string, u string")
    out = top_k_labels(df, ["g"], "t", count_of="u", k=3, out_col="s")
    assert out.collect()[0].s == "t0|t1|t10"
    out2 = top_k_label_set(df, ["g"], "t", count_of="u", k=3, out_col="s")
    assert out2.collect()[0].s == "t0|t1|t10"


def _log(uuid, site, rectime, stays, clicks):
    return (uuid, "acc", rectime, "1", "v", "dev", site, "pkg", (stays, clicks))


def test_flatten_drops_empty_null_arrays_and_null_time(spark):
    data = [
        _log("u1", "ALI", 1706572800000, [(1, 10, 20, "x"), (None, 10, 20, "y")], None),
        _log("u2", "IQIYI", 1706572800000, [], []),
        _log("u3", "BESTV", 1706572800000, None, [(1, "c", "1,1", "t", "k")]),
    ]
    logs = spark.createDataFrame(data, LOG_RECORD)
    stays = flatten_events(logs, "data.launcher_page_stay", ["enter", "exit", "title"], keep=["custom_uuid"])
    assert rows(stays) == [("u1", "10", "20", "x")]
    no_filter = flatten_events(logs, "data.launcher_page_stay", ["title"], keep=["custom_uuid"], not_null=())
    assert rows(no_filter) == [("u1", "x"), ("u1", "y")]


def test_missing_category_fill(spark):
    data = [_log("u1", "ALI", 1706572800000, None, [(1, None, "1,1", "t", "k")])]
    logs = spark.createDataFrame(data, LOG_RECORD)
    got = heatmap.click_rows(logs, missing_category="null").collect()
    assert [(r.site, r.category, r.dt) for r in got] == [("youku", "null", "2024-01-30")]


def test_record_day_at_midnight_and_zone(spark):
    lo, hi = day_bounds_ms(D0)
    data = [_log("u1", "ALI", lo - 1, [(1, 10, 20, "x")], None),
            _log("u2", "ALI", lo, [(1, 10, 20, "x")], None),
            _log("u3", "ALI", hi - 1, [(1, 10, 20, "x")], None)]
    logs = spark.createDataFrame(data, LOG_RECORD)
    utc = {r.custom_uuid: r.dt for r in exposure.page_stay_rows(logs).collect()}
    assert utc == {"u1": "2024-01-29", "u2": "2024-01-30", "u3": "2024-01-30"}
    sh = {r.custom_uuid: r.dt for r in exposure.page_stay_rows(logs, tz="Asia/Shanghai").collect()}
    assert sh == {"u1": "2024-01-30", "u2": "2024-01-30", "u3": "2024-01-31"}
    assert day_bounds_ms(D0, "Asia/Shanghai")[0] == lo - 8 * 3600 * 1000


def test_epoch_round_trip_ignores_session_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-07-15 13:45:07.999688' AS ts")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        out = []
        for zone in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            out.append(df.select(epoch_millis("ts").alias("ms"),
                                 local_day(epoch_millis("ts")).alias("d"),
                                 wall_clock(epoch_millis("ts")).alias("w")).collect()[0])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert out[0] == out[1]
    assert out[0].ms == 1721051107999 and out[0].d == dt.date(2024, 7, 15)


def test_first_seen_keeps_all_rows_of_the_first_day(spark):
    df = spark.createDataFrame(
        [("a", D0, "x"), ("a", D0, "y"), ("b", D1, "x"), ("b", D0, "z"), ("c", dt.date(2024, 2, 1), "x")],
        "acct string, day date, v string")
    days = list(report_days(D0).values())
    got = rows(first_seen(df, ["acct"], "day", days))
    assert got == [("a", D0, "x", D0), ("a", D0, "y", D0), ("b", D1, "x", D1)]
    # NULL keys form a group, like a window partition does
    nulls = spark.createDataFrame([(None, D7, "x"), (None, D0, "y")], "acct string, day date, v string")
    assert rows(first_seen(nulls, ["acct"], "day", days)) == [(None, D7, "x", D7)]


def test_fact_and_sales_package_presets_differ(spark):
    from daybook.functions.dates import day_bounds_ms
    from daybook.plans import sales

    t = day_bounds_ms(D0)[0] + 1000
    orders = spark.createDataFrame(
        [("2CET3Y", "iqiyi", 1000, 2, 4, 1, t), ("2cet3y", "iqiyi", 500, 3, 4, 1, t),
         ("zzz", "mango", 100, 3, 4, 1, t), ("xqla4e", "Youku", 300, 1, 4, 1, t)],
        "package_id string, order_provide string, order_price long, order_type int, order_status int, "
        "order_state int, order_delevetime long")
    fact = {(r.channelName, r.vipType, r.packageName): (r.sellCount, r.moneyCount)
            for r in sales.daily_order_fact(orders, D0).collect()}
    assert fact == {("iqiyi", 2, "年卡"): (2, 15.0), ("others", 2, "单点"): (1, 1.0), ("youku", 1, "年卡"): (1, 3.0)}
    cube = sales.daily_sales_cube(orders, [D0]).where("id_1 = 0").collect()
    got = {(r.channelName, r.packageName): r.sellCount for r in cube}
    # the daily report's preset has no 2cet3y: a purchase stays NULL, a single title falls back
    assert got == {("iqiyi", None): 1, ("iqiyi", "单点"): 1, ("others", "单点"): 1}


def test_compare_with_custom_baselines(spark):
    cube = _cube(spark, [(D0, "a", "p", 10), (D0 - dt.timedelta(days=28), "a", "p", 5)])
    out = compare_periods(cube, day_col="day", report_day=D0, keys={"k1": "k1", "k2": "k2"},
                          metrics={"v": ("total", "v")}, baselines={"Month": 28})
    assert out.columns == ["date", "k1", "k2", "id_1", "total", "vCompareMonth"]
    assert {r.vCompareMonth for r in out.collect()} == {"100.0%"}
