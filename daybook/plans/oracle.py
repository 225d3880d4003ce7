"""DuckDB oracle SQL for every registered query.

Written independently of the Spark code: the test views are re-derived in SQL
from the raw tables, cubes are SQL ``GROUP BY ... CUBE/GROUPING SETS`` and the
period comparisons use the classic join form (null-safe ``IS NOT DISTINCT
FROM`` left joins), while the Spark side pivots a single aggregate.

Engine differences handled here (each would give a false mismatch):

* ``round(x, 2)`` of a double: Spark rounds the shortest decimal form HALF_UP,
  DuckDB rounds ``x * 100``; ``r2`` rounds the decimal form in DuckDB too.
* ``concat(NULL, '%')`` is ``'%'`` in DuckDB: use ``||``.
* ``x / 0``: ``NULLIF`` the divisor (Spark reports use ``try_divide``).
* ``sum`` of integers is HUGEINT: cast to BIGINT.
* ``GROUPING(...)`` with arguments has ``grouping_id()``'s bit order.
* default NULL ordering differs: every ORDER BY names it.
* ``epoch_ms(ts)`` rounds sub-millisecond parts: ``epoch_us(ts) // 1000`` truncates like Spark.

* doubles of 1e7 and more print as ``1.0E7`` in Spark (Java formatting):
  ``java_double`` formats the percent changes the same way.
"""

from __future__ import annotations

import datetime as dt

from ..functions.presets import (
    AUTO_RENEW, ANNUAL, GIFT, HALF_YEAR, MAX_STAY_SECONDS, MONTHLY, QUARTER, SINGLE_TITLE,
    TOP_TITLES,
)
from ..sources.fixtures import (
    ACCOUNT_BASE_DAY, EVENTS_DAY, FIXTURE_MIN_GROUP, FIXTURE_MIN_TITLE, MEMBERS_DAY,
)

MS_PER_DAY = 86_400_000


# ----------------------------------------------------------------- helpers
def ems(ts: str) -> str:
    """epoch milliseconds, truncated (DuckDB's epoch_ms rounds sub-millisecond parts)."""
    return f"(epoch_us({ts}) // 1000)"


def r2(x: str) -> str:
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,24)), 2) AS DOUBLE)"


def pct_value(cur: str, base: str) -> str:
    """The rounded percent change as a double (NULL without a non-zero base)."""
    return r2(f"(({cur}) / NULLIF({base}, 0) - 1) * 100")


def java_double(x: str) -> str:
    """``x`` (a column name) as Java prints a double: plain below 1e7, else ``d.dddE<n>``.

    Built from DuckDB's shortest digits, which print plainly below 1e16 and as
    ``d.ddde+NN`` above.
    """
    s = f"CAST(abs({x}) AS VARCHAR)"
    ip, fp = f"split_part({s}, '.', 1)", f"split_part({s}, '.', 2)"
    digits = f"rtrim({ip} || {fp}, '0')"
    plain = (f"left({digits}, 1) || '.' || CASE WHEN length({digits}) > 1 THEN substr({digits}, 2) ELSE '0' END"
             f" || 'E' || CAST(length({ip}) - 1 AS VARCHAR)")
    mant = f"split_part({s}, 'e', 1)"
    sci = (f"CASE WHEN contains({mant}, '.') THEN {mant} ELSE {mant} || '.0' END"
           f" || 'E' || CAST(CAST(split_part({s}, 'e', 2) AS INTEGER) AS VARCHAR)")
    big = f"CASE WHEN contains({s}, 'e') THEN {sci} ELSE {plain} END"
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN abs({x}) < 1e7 THEN CAST({x} AS VARCHAR) "
            f"ELSE CASE WHEN {x} < 0 THEN '-' ELSE '' END || {big} END")


def days_of(d0: dt.date) -> tuple[dt.date, dt.date, dt.date]:
    return d0, d0 - dt.timedelta(days=1), d0 - dt.timedelta(days=7)


def qd(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


def qs(d: dt.date) -> str:
    return f"'{d.isoformat()}'"


def date_key(d: dt.date) -> str:
    return f"CAST({d.strftime('%Y%m%d')} AS INTEGER)"


def nsafe(a: str, b: str, cols) -> str:
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols)


def compare_sql(cube: str, day_col: str, d0: dt.date, day_lit, keys: dict, metrics: dict,
                extra_select: str = "", extra_join: str = "") -> str:
    """Join-form period comparison over a per-day aggregate CTE named ``cube``."""
    _, d1, d7 = days_of(d0)
    keylist = list(keys)
    inner = [f"t0.{k} AS {v}" for k, v in keys.items()]
    if extra_select:
        inner.append(extra_select)
    inner.append("t0.id_1 AS id_1")
    outer = [f'{date_key(d0)} AS "date"'] + list(keys.values())
    if extra_select:
        outer.append(extra_select.split(" AS ")[-1])
    outer.append("id_1")
    for m, (total, prefix) in metrics.items():
        inner += [f"t0.{m} AS {total}", f"{pct_value(f't0.{m}', f't1.{m}')} AS {prefix}_day",
                  f"{pct_value(f't0.{m}', f't7.{m}')} AS {prefix}_week"]
        outer += [total, f"{java_double(f'{prefix}_day')} || '%' AS {prefix}CompareDay",
                  f"{java_double(f'{prefix}_week')} || '%' AS {prefix}CompareWeek"]
    return f"""
, t0 AS (SELECT * FROM {cube} WHERE {day_col} = {day_lit(d0)})
, t1 AS (SELECT * FROM {cube} WHERE {day_col} = {day_lit(d1)})
, t7 AS (SELECT * FROM {cube} WHERE {day_col} = {day_lit(d7)})
, compared AS (
  SELECT {", ".join(inner)}
  FROM t0
  {extra_join}
  LEFT JOIN t1 ON {nsafe('t0', 't1', keylist)} AND t0.id_1 = t1.id_1
  LEFT JOIN t7 ON {nsafe('t0', 't7', keylist)} AND t0.id_1 = t7.id_1)
SELECT {", ".join(outer)} FROM compared
"""


# ------------------------------------------------------------- fixture views
EV = "ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"

PROVIDER_CODE = """CASE {x} % 5 WHEN 0 THEN 'iQIYI' WHEN 1 THEN 'Youku' WHEN 2 THEN 'BesTV'
  WHEN 3 THEN 'bestv:pptv' ELSE 'mango' END"""

CHANNEL_OF_PROVIDER = """CASE WHEN lower({x}) = 'iqiyi' THEN 'iqiyi' WHEN lower({x}) = 'youku' THEN 'youku'
  WHEN lower({x}) IN ('bestv', 'bestv:pptv') THEN 'bestv' ELSE 'others' END"""


def package_label(x: str, single_title_type: str | None = None, fact: bool = False) -> str:
    """Fixture package preset as a CASE on lower(id); ``fact``: the daily fact's, with one annual id more."""
    blocks = ((ANNUAL, 0, 4), (HALF_YEAR, 4, 8), (QUARTER, 8, 12), (MONTHLY, 12, 16), (AUTO_RENEW, 16, 19))
    whens = []
    for label, lo, hi in blocks:
        more = [19] if fact and label == ANNUAL else []
        ids = ", ".join(f"'pk{i}'" for i in [*range(lo, hi), *more])
        whens.append(f"WHEN lower({x}) IN ({ids}) THEN '{label}'")
    if single_title_type:
        whens.append(f"WHEN {single_title_type} = 3 THEN '{SINGLE_TITLE}'")
    return "CASE " + " ".join(whens) + " END"


# launcher page stays (V3), flattened, with the stay length in seconds
STAY = f"""{EV},
stay_src AS (
  SELECT *, epoch_us(ts) // 1000000 AS enter_s,
         epoch_us(ts) // 1000000 + CAST(floor(value * 10) AS BIGINT)
           - CASE WHEN k % 7 = 0 THEN 600 ELSE 0 END AS exit_s,
         CASE k % 4 WHEN 0 THEN 'ALI' WHEN 1 THEN 'IQIYI' WHEN 2 THEN 'BESTV' ELSE 'XX' END AS site_code
  FROM ev),
stay AS (
  SELECT CASE WHEN k % 17 = 0 THEN NULL ELSE 'u' || CAST(user_id AS VARCHAR) END AS custom_uuid,
         'a' || CAST(user_id AS VARCHAR) AS account,
         CAST(ts AS DATE) AS date,
         CASE site_code WHEN 'ALI' THEN 'youku' WHEN 'IQIYI' THEN 'iqiyi' WHEN 'BESTV' THEN 'bestv'
           ELSE 'others' END AS site,
         CAST(100 + k % 3 AS VARCHAR) AS vercode,
         'v1.' || CAST(k % 3 AS VARCHAR) AS vername,
         'box' || CAST(user_id % 4 AS VARCHAR) AS device_name,
         epoch_ms(enter_s * 1000) AS enter,
         epoch_ms(exit_s * 1000) AS exit,
         CASE WHEN k % 10 = 9 THEN NULL ELSE event_type END AS title,
         strftime(CAST(ts AS DATE), '%Y-%m-%d') AS dt,
         exit_s - enter_s AS secs
  FROM stay_src
  WHERE k % 13 <> 0)"""


def exposure_cube_cte(d0: dt.date) -> str:
    days = ", ".join(qs(d) for d in days_of(d0))
    return f"""exposure AS (
  SELECT dt, site, title, CAST(GROUPING(dt, site, title) AS BIGINT) AS id_1,
         COUNT(custom_uuid) AS playNum,
         {r2('SUM(secs) / 3600')} AS playTime,
         COUNT(DISTINCT custom_uuid) AS users,
         {r2('COUNT(custom_uuid) / NULLIF(COUNT(DISTINCT custom_uuid), 0)')} AS avgPlayNum,
         {r2('SUM(secs) / NULLIF(COUNT(DISTINCT custom_uuid), 0) / 60')} AS avgPlayTime
  FROM stay
  WHERE dt IN ({days}) AND exit >= enter AND secs <= {MAX_STAY_SECONDS}
  GROUP BY dt, CUBE(site, title))"""


EXPOSURE_METRICS = {
    "playNum": ("totalPlayNum", "playNum"),
    "playTime": ("totalPlayTime", "playTime"),
    "users": ("totalUserCount", "userCount"),
    "avgPlayNum": ("averagePlayNum", "avgPlayNum"),
    "avgPlayTime": ("averagePlayTime", "avgPlayTime"),
}


def page_stay_flatten() -> str:
    return f"""WITH {STAY}
SELECT custom_uuid, account, date, site, vercode, vername, device_name, enter, exit,
       CAST(secs AS BIGINT) AS "staySeconds", title, dt
FROM stay"""


def page_exposure_cube() -> str:
    return f"WITH {STAY}, {exposure_cube_cte(EVENTS_DAY)} SELECT * FROM exposure"


def page_exposure_report() -> str:
    return (f"WITH {STAY}, {exposure_cube_cte(EVENTS_DAY)}"
            + compare_sql("exposure", "dt", EVENTS_DAY, qs, {"site": "channelName", "title": "typeName"},
                          EXPOSURE_METRICS))


def weekly_exposure_report() -> str:
    """Two weeks of raw stays, each user counted once a week, joined."""
    d0 = EVENTS_DAY
    ends = [d0, d0 - dt.timedelta(days=7)]
    cubes = [f"""SELECT {qs(end)} AS period, site, title, CAST(GROUPING(site, title) AS BIGINT) AS id_1,
         COUNT(custom_uuid) AS playNum, {r2('SUM(secs) / 3600')} AS playTime, COUNT(DISTINCT custom_uuid) AS users,
         {r2('COUNT(custom_uuid) / NULLIF(COUNT(DISTINCT custom_uuid), 0)')} AS avgPlayNum,
         {r2('SUM(secs) / NULLIF(COUNT(DISTINCT custom_uuid), 0) / 60')} AS avgPlayTime
  FROM stay WHERE date BETWEEN {qd(end - dt.timedelta(days=6))} AND {qd(end)} AND exit >= enter AND secs <= {MAX_STAY_SECONDS}
  GROUP BY CUBE(site, title)""" for end in ends]
    changes = ", ".join(
        f"""t0.{m} AS {total}, {java_double(pct_value(f't0.{m}', f't7.{m}'))} || '%' AS {prefix}CompareWeek"""
        for m, (total, prefix) in EXPOSURE_METRICS.items())
    return f"""WITH {STAY},
weeks AS ({" UNION ALL ".join(cubes)}),
t0 AS (SELECT * FROM weeks WHERE period = {qs(ends[0])}), t7 AS (SELECT * FROM weeks WHERE period = {qs(ends[1])})
SELECT {date_key(d0)} AS date, t0.site AS channelName, t0.title AS typeName, t0.id_1 AS id_1, {changes}
FROM t0 LEFT JOIN t7 ON {nsafe('t0', 't7', ['site', 'title', 'id_1'])}"""


# ------------------------------------------------------------------- sales (V2)
def r0_bigint(x: str) -> str:
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,24)), 0) AS BIGINT)"


SALES_ORDERS = f"""{EV},
so AS (
  SELECT 'PK' || CAST(event_id % 24 AS VARCHAR) AS package_id,
         {PROVIDER_CODE.format(x='k')} AS order_provide,
         {r0_bigint('value * 100')} AS order_price,
         CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 WHEN 'view' THEN 3 ELSE 9 END AS order_type,
         CASE WHEN k % 10 <> 0 THEN 4 ELSE 1 END AS order_status,
         CASE WHEN k % 9 <> 0 THEN 1 ELSE 0 END AS order_state,
         {ems('ts')} AS order_delevetime
  FROM ev)"""

FACT_ORDERS = f"""so AS (
  SELECT 'PK' || CAST(o_orderkey % 24 AS VARCHAR) AS package_id,
         {PROVIDER_CODE.format(x='o_custkey')} AS order_provide,
         {r0_bigint('o_totalprice * 100')} AS order_price,
         CAST(o_orderkey % 3 + 1 AS INTEGER) AS order_type,
         CASE WHEN o_orderstatus IN ('F', 'O') THEN 4 ELSE 1 END AS order_status,
         1 AS order_state,
         {ems('o_orderdate')} AS order_delevetime
  FROM orders)"""


def sales_cube_cte(d0: dt.date) -> str:
    days = ", ".join(qd(d) for d in days_of(d0))
    return f"""sales AS (
  SELECT CAST(epoch_ms(order_delevetime) AS DATE) AS day,
         {CHANNEL_OF_PROVIDER.format(x='order_provide')} AS channelName,
         {package_label('package_id', 'order_type')} AS packageName,
         order_price
  FROM so
  WHERE order_status = 4 AND order_state = 1 AND order_type IN (2, 3)
    AND CAST(epoch_ms(order_delevetime) AS DATE) IN ({days})),
sales_cube AS (
  SELECT day, channelName, packageName, CAST(GROUPING(day, channelName, packageName) AS BIGINT) AS id_1,
         COUNT(*) AS sellCount, {r2('SUM(order_price) / 100')} AS moneyCount
  FROM sales GROUP BY day, CUBE(channelName, packageName))"""


def fact_cte(day_filter: str, fact_preset: bool = False) -> str:
    return f"""fact AS (
  SELECT strftime(epoch_ms(order_delevetime), '%Y%m%d') AS date,
         {CHANNEL_OF_PROVIDER.format(x='order_provide')} AS channelName,
         CASE WHEN order_type = 1 THEN 1 ELSE 2 END AS vipType,
         {package_label('package_id', 'order_type', fact_preset)} AS packageName,
         COUNT(*) AS sellCount, {r2('SUM(order_price) / 100')} AS moneyCount
  FROM so
  WHERE order_status = 4 AND order_state = 1 AND order_type IN (1, 2, 3) {day_filter}
  GROUP BY ALL)"""


def daily_order_fact() -> str:
    return (f"WITH {SALES_ORDERS}, "
            + fact_cte(f"AND CAST(epoch_ms(order_delevetime) AS DATE) = {qd(EVENTS_DAY)}", True)
            + " SELECT * FROM fact")


def daily_sales_cube() -> str:
    return f"WITH {SALES_ORDERS}, {sales_cube_cte(EVENTS_DAY)} SELECT * FROM sales_cube"


def daily_sales_report() -> str:
    return (f"WITH {SALES_ORDERS}, {sales_cube_cte(EVENTS_DAY)}"
            + compare_sql("sales_cube", "day", EVENTS_DAY, qd,
                          {"channelName": "channelName", "packageName": "packageName"},
                          {"sellCount": ("sellCount", "sellCount"), "moneyCount": ("moneyCount", "moneyCount")}))


def monthly_sales_cube() -> str:
    return f"""WITH {FACT_ORDERS}, {fact_cte('')},
months AS (SELECT substr(date, 1, 6) AS month, * FROM fact WHERE date IS NOT NULL)
SELECT month, channelName, vipType, packageName,
       CAST(GROUPING(month, channelName, vipType, packageName) AS BIGINT) AS id_1,
       CAST(SUM(sellCount) AS BIGINT) AS sellCount,
       CAST(round(SUM(CAST(moneyCount AS DECIMAL(38,2))), 2) AS DOUBLE) AS moneyCount
FROM months GROUP BY month, CUBE(channelName, vipType, packageName)"""


# -------------------------------------------------------------- membership (V1)
def member_views(d0: dt.date) -> str:
    """V1 tables and the reference-shaped pull (day compared as a DATE, like MySQL did)."""
    base = (ACCOUNT_BASE_DAY - dt.date(1970, 1, 1)).days
    return f"""acc AS (
  SELECT c_custkey AS account_id, c_name AS account_name,
         (CAST({base} AS BIGINT) + c_custkey % 60) * {MS_PER_DAY} AS account_addtime
  FROM customer),
ord AS (
  SELECT o_orderkey AS order_id, o_custkey AS account_id, CAST(o_orderkey % 3 + 1 AS INTEGER) AS order_type,
         CASE WHEN o_orderstatus IN ('F', 'O') THEN 4 ELSE 1 END AS order_status,
         'PK' || CAST(o_orderkey % 24 AS VARCHAR) AS package_id,
         {ems('o_orderdate')} AS order_addtime
  FROM orders),
rgt AS (
  SELECT l_orderkey AS order_id, {PROVIDER_CODE.format(x='l_partkey')} AS package_provide,
         {ems('l_shipdate')} AS right_starttime,
         {ems('l_shipdate')} + CAST(l_quantity AS BIGINT) * {MS_PER_DAY} AS right_limitdate
  FROM lineitem),
pull AS MATERIALIZED (
  SELECT DISTINCT a.account_name, o.order_type, o.package_id, r.package_provide,
         CAST(epoch_ms(r.right_starttime) AS DATE) AS right_starttime,
         CAST(epoch_ms(r.right_limitdate) AS DATE) AS right_limittime,
         CAST(epoch_ms(o.order_addtime) AS DATE) AS order_addtime
  FROM rgt r
  JOIN ord o ON r.order_id = o.order_id AND CAST(epoch_ms(o.order_addtime) AS DATE) <= {qd(d0)}
            AND o.order_type IN (1, 2) AND o.order_status = 4
  JOIN acc a ON o.account_id = a.account_id AND CAST(epoch_ms(a.account_addtime) AS DATE) <= {qd(d0)}),
labeled AS MATERIALIZED (
  SELECT account_name, order_type, {CHANNEL_OF_PROVIDER.format(x='package_provide')} AS channelName,
         {package_label('package_id')} AS package,
         CASE WHEN order_type = 1 THEN '{GIFT}' ELSE {package_label('package_id')} END AS packageName,
         right_starttime, right_limittime, order_addtime
  FROM pull)"""


def first_seen_cte(d0: dt.date, keys: str) -> str:
    """The reference's per-day window form, once per report day, unioned."""
    parts = []
    for d in days_of(d0):
        parts.append(f"""SELECT account_name, order_type, channelName, package, packageName,
         right_starttime, right_limittime, {qd(d)} AS registtime
  FROM (SELECT *, min(order_addtime) OVER (PARTITION BY {keys}) AS first_day
        FROM labeled WHERE order_addtime <= {qd(d)}) w
  WHERE first_day = {qd(d)}""")
    return "fs AS MATERIALIZED (\n  " + "\n  UNION ALL\n  ".join(parts) + ")"


MEMBER_CUBE = """members_cube AS MATERIALIZED (
  SELECT registtime, channelName, packageName,
         CAST(GROUPING(registtime, channelName, packageName) AS BIGINT) AS id_1,
         COUNT(DISTINCT account_name) AS totalUserCount
  FROM fs GROUP BY registtime, CUBE(channelName, packageName))"""

BY_CHANNEL = "account_name, order_type, channelName"
BY_ACCOUNT = "account_name"


def member_pull() -> str:
    return f"WITH {member_views(MEMBERS_DAY)} SELECT * FROM pull"


def channel_package_labels() -> str:
    return f"WITH {member_views(MEMBERS_DAY)} SELECT * FROM labeled"


def first_seen(keys: str) -> str:
    return f"WITH {member_views(MEMBERS_DAY)}, {first_seen_cte(MEMBERS_DAY, keys)} SELECT * FROM fs"


def new_members_cube() -> str:
    return (f"WITH {member_views(MEMBERS_DAY)}, {first_seen_cte(MEMBERS_DAY, BY_CHANNEL)}, {MEMBER_CUBE} "
            "SELECT * FROM members_cube")


def new_members_report(keys: str) -> str:
    return (f"WITH {member_views(MEMBERS_DAY)}, {first_seen_cte(MEMBERS_DAY, keys)}, {MEMBER_CUBE}"
            + compare_sql("members_cube", "registtime", MEMBERS_DAY, qd,
                          {"channelName": "channelName", "packageName": "packageName"},
                          {"totalUserCount": ("totalUserCount", "userCount")}))


def member_first_state() -> str:
    """Every key's first day over the whole pull, with that day's label combinations."""
    return f"""WITH {member_views(MEMBERS_DAY)},
tagged AS (SELECT *, min(order_addtime) OVER (PARTITION BY {BY_CHANNEL}) AS first_day FROM labeled)
SELECT DISTINCT account_name, order_type, channelName, packageName, strftime(first_day, '%Y-%m-%d') AS first_day
FROM tagged WHERE order_addtime = first_day"""


# ---------------------------------------------------------------- heat map (V4)
CLICKS = f"""{EV},
clicks AS (
  SELECT CASE WHEN k % 17 = 0 THEN NULL ELSE 'u' || CAST(user_id AS VARCHAR) END AS custom_uuid,
         CASE k % 4 WHEN 0 THEN 'youku' WHEN 1 THEN 'iqiyi' WHEN 2 THEN 'bestv' ELSE 'others' END AS site,
         CASE WHEN k % 23 = 0 THEN NULL ELSE event_type END AS category,
         CASE WHEN k % 10 = 9 THEN 'nav'
              ELSE CAST(CAST(floor(k / 50) AS BIGINT) AS VARCHAR) || ',' || CAST(k % 2 AS VARCHAR) END AS position,
         CASE WHEN k % 19 = 0 THEN NULL ELSE 't' || CAST(k % 8 AS VARCHAR) END AS title,
         event_type AS type,
         strftime(CAST(ts AS DATE), '%Y-%m-%d') AS dt
  FROM ev
  WHERE k % 13 <> 0)"""


def launcher_items() -> str:
    stays = """SELECT 'stay' AS kind, custom_uuid, account, date, site, vercode, vername, device_name, enter, exit,
       CAST(secs AS BIGINT) AS "staySeconds", title, NULL AS category, NULL AS position, NULL AS type, dt FROM stay"""
    clicks = """SELECT 'click', custom_uuid, NULL, NULL, site, NULL, NULL, NULL, NULL, NULL, NULL, title, category, position, type, dt
FROM clicks"""
    return f"WITH {STAY}, {CLICKS.removeprefix(EV).lstrip(',').strip()} {stays} UNION ALL {clicks}"


def gsets_cte(d0: dt.date, min_count: int) -> str:
    days = ", ".join(qs(d) for d in days_of(d0))
    return f"""gsets AS (
  SELECT dt, site, category, position,
         CAST(GROUPING(dt, site, category, position) AS BIGINT) AS id_1,
         COUNT(custom_uuid) AS playNum, COUNT(DISTINCT custom_uuid) AS users
  FROM clicks
  WHERE dt IN ({days}) AND position LIKE '%,%'
  GROUP BY GROUPING SETS ((dt, site, category, position), (dt, site, category))
  HAVING COUNT(custom_uuid) >= {min_count})"""


def ranked_titles_cte(d0: dt.date, min_count: int, non_null: bool) -> str:
    title_filter = "AND title IS NOT NULL" if non_null else ""
    return f"""counted AS (
  SELECT site, category, position, title, COUNT(custom_uuid) AS playNum
  FROM clicks WHERE dt = {qs(d0)} AND position LIKE '%,%' {title_filter}
  GROUP BY site, category, position, title
  HAVING COUNT(custom_uuid) >= {min_count}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY site, category, position
                               ORDER BY playNum DESC, title ASC NULLS LAST) AS rn
  FROM counted)"""


TOP_TITLES_CTE = f"""top3 AS (
  SELECT site, category, position, string_agg(title, '|' ORDER BY rn) AS title_set
  FROM ranked WHERE rn <= {TOP_TITLES} GROUP BY site, category, position)"""


def click_flatten() -> str:
    return f"WITH {CLICKS} SELECT * FROM clicks"


def click_grouping_sets() -> str:
    return f"WITH {CLICKS}, {gsets_cte(EVENTS_DAY, FIXTURE_MIN_GROUP)} SELECT * FROM gsets"


def top_titles() -> str:
    return (f"WITH {CLICKS}, {ranked_titles_cte(EVENTS_DAY, FIXTURE_MIN_TITLE, True)}, {TOP_TITLES_CTE} "
            "SELECT * FROM top3")


def top_titles_set() -> str:
    return f"""WITH {CLICKS}, {ranked_titles_cte(EVENTS_DAY, FIXTURE_MIN_TITLE, False)}
SELECT site, category, position,
       COALESCE(array_to_string(list_sort(list_distinct(list(title) FILTER (WHERE title IS NOT NULL))), '|'), '')
         AS title_set
FROM ranked WHERE rn <= {TOP_TITLES} GROUP BY site, category, position"""


def click_heatmap_report() -> str:
    join = ("LEFT JOIN top3 tt ON t0.site IS NOT DISTINCT FROM tt.site "
            "AND t0.category IS NOT DISTINCT FROM tt.category AND t0.position IS NOT DISTINCT FROM tt.position")
    return (f"WITH {CLICKS}, {gsets_cte(EVENTS_DAY, FIXTURE_MIN_GROUP)}, "
            f"{ranked_titles_cte(EVENTS_DAY, FIXTURE_MIN_TITLE, True)}, {TOP_TITLES_CTE}"
            + compare_sql("gsets", "dt", EVENTS_DAY, qs,
                          {"site": "channelName", "category": "entryName", "position": "position"},
                          {"playNum": ("totalPlayCount", "playCount"), "users": ("totalUserCount", "userCount")},
                          extra_select="tt.title_set AS titleSet", extra_join=join))


def all_sql() -> dict[str, str]:
    return {
        "launcher_items": launcher_items(),
        "click_flatten": click_flatten(),
        "click_grouping_sets": click_grouping_sets(),
        "top_titles": top_titles(),
        "top_titles_set": top_titles_set(),
        "click_heatmap_report": click_heatmap_report(),
        "member_pull": member_pull(),
        "channel_package_labels": channel_package_labels(),
        "first_seen_by_channel": first_seen(BY_CHANNEL),
        "first_seen_by_account": first_seen(BY_ACCOUNT),
        "new_members_cube": new_members_cube(),
        "new_members_report": new_members_report(BY_CHANNEL),
        "new_members_report_v2": new_members_report(BY_ACCOUNT),
        "member_first_state": member_first_state(),
        "new_members_incremental": new_members_report(BY_CHANNEL),
        "new_members_incremental_v2": new_members_report(BY_ACCOUNT),
        "daily_order_fact": daily_order_fact(),
        "daily_sales_cube": daily_sales_cube(),
        "daily_sales_report": daily_sales_report(),
        "monthly_sales_cube": monthly_sales_cube(),
        "monthly_sales_refreshed": monthly_sales_cube(),
        "page_stay_flatten": page_stay_flatten(),
        "page_exposure_cube": page_exposure_cube(),
        "page_exposure_report": page_exposure_report(),
        "page_audience_cube": page_exposure_cube(),
        "page_audience_report": page_exposure_report(),
        "weekly_exposure_report": weekly_exposure_report(),
    }
