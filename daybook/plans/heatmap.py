"""Launcher click heat map (R8): clicks per screen position with the top titles,
compared with the previous day and week."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import BASELINES, as_day, epoch_count, iso, report_days, wall_clock
from ..functions.labels import label_map
from ..functions.presets import MIN_GROUP_COUNT, SITE_CHANNELS, TOP_TITLES
from ..operators.compare import compare_periods
from ..operators.flatten import flatten_events
from ..operators.rollup import rollup
from ..operators.topk import top_k_label_set, top_k_labels

CLICK_FIELDS = ("category", "position", "title", "type")
GROUP_KEYS = ["site", "category", "position"]
HEATMAP_SETS = [["site", "category", "position"], ["site", "category"]]
HEATMAP_METRICS = {"playNum": ("totalPlayCount", "playCount"), "users": ("totalUserCount", "userCount")}


def click_rows(logs: DataFrame, *, tz: str = "UTC", day_col: str | None = None,
               missing_category: str | None = None) -> DataFrame:
    """Flatten ``data.home_item_click`` (C6): one row per click with a ``time``.

    ``dt`` is the record day from ``rectime``, or the column ``day_col`` (e.g.
    the day of the input folder). ``missing_category`` fills a NULL category.
    """
    keep = ["custom_uuid", "rectime", "site"] + ([day_col] if day_col else [])
    fill = {"category": F.lit(missing_category)} if missing_category is not None else None
    flat = flatten_events(logs, "data.home_item_click", CLICK_FIELDS, keep=keep, not_null=["time"],
                          fill=fill)
    day = F.col(day_col) if day_col else F.to_date(
        wall_clock(epoch_count("rectime", "MILLISECOND"), tz=tz)).cast("string")
    return flat.select("custom_uuid", label_map("site", SITE_CHANNELS).alias("site"),
                       "category", "position", "title", "type", day.alias("dt"))


def _positions(clicks: DataFrame) -> DataFrame:
    # screen positions are "x,y"; anything else (NULL, "nav") is not a grid cell
    return clicks.where(F.col("position").like("%,%"))


def click_grouping_sets(clicks: DataFrame, days: Iterable, *, min_count: int = MIN_GROUP_COUNT) -> DataFrame:
    """``GROUP BY dt, GROUPING SETS((site,category,position),(site,category))``
    with ``HAVING count(custom_uuid) >= min_count`` on every day (A6, P9, P16)."""
    rows = _positions(clicks.where(F.col("dt").isin([iso(d) for d in days])))
    metrics = [F.count("custom_uuid").alias("playNum"), F.count_distinct("custom_uuid").alias("users")]
    return rollup(rows, GROUP_KEYS, metrics, sets=HEATMAP_SETS, always=["dt"],
                  having=F.col("playNum") >= F.lit(min_count))


def top_titles(clicks: DataFrame, day, *, k: int = TOP_TITLES, min_count: int = MIN_GROUP_COUNT,
               sep: str = "|") -> DataFrame:
    """Per screen position of ``day``: the k most clicked titles, best first."""
    rows = _positions(clicks.where(F.col("dt") == iso(day)))
    return top_k_labels(rows, GROUP_KEYS, "title", count_of="custom_uuid", k=k, min_count=min_count,
                        sep=sep)


def top_titles_set(clicks: DataFrame, day, *, k: int = TOP_TITLES, min_count: int = MIN_GROUP_COUNT,
                   sep: str = "|") -> DataFrame:
    """Unordered variant (A10): NULL titles rank too, the kept titles sorted by name."""
    rows = _positions(clicks.where(F.col("dt") == iso(day)))
    return top_k_label_set(rows, GROUP_KEYS, "title", count_of="custom_uuid", k=k, min_count=min_count,
                           sep=sep)


def click_heatmap_report(clicks: DataFrame, report_day, *, min_count: int = MIN_GROUP_COUNT,
                         title_min_count: int | None = None, k: int = TOP_TITLES, sep: str = "|",
                         baselines: Mapping[str, int] = BASELINES) -> DataFrame:
    """Clicks and users per (channel, entry, position) and per (channel, entry),
    with the report day's top titles and the day/week comparison.

    The distinct user counts expand a click into the two report groupings only.
    Titles need one day and no distinct count: a map-side combined count, ranked under
    a group limit, joined null-safely (J4) to the aggregated cells. Subtotal rows
    (position rolled up) get no title set.
    """
    d0 = as_day(report_day)
    days = report_days(d0, baselines)
    gsets = click_grouping_sets(clicks, days.values(), min_count=min_count)
    base = compare_periods(gsets, day_col="dt", report_day=d0,
                           keys={"site": "channelName", "category": "entryName", "position": "position"},
                           metrics=HEATMAP_METRICS, baselines=baselines, day_value=iso)
    titles = top_titles(clicks, d0, k=k, sep=sep,
                        min_count=min_count if title_min_count is None else title_min_count)
    return _with_titles(base, titles)


def click_heatmap_report_one_pass(clicks: DataFrame, report_day, *, min_count: int = MIN_GROUP_COUNT,
                                  title_min_count: int | None = None, k: int = TOP_TITLES, sep: str = "|",
                                  baselines: Mapping[str, int] = BASELINES) -> DataFrame:
    """R8 with one scan and one aggregation (``heatmap_cells``), a window over the small
    aggregate and one grouped pivot. It reads a gzip log once, but sends a third expanded
    """
    days = report_days(as_day(report_day), baselines)
    return click_heatmap_from_cells(heatmap_cells(clicks, days.values()), report_day, min_count=min_count,
                                    title_min_count=title_min_count, k=k, sep=sep, baselines=baselines)


def _with_titles(base: DataFrame, titles: DataFrame) -> DataFrame:
    """Left join of the report rows with the title sets on null-safe cell keys."""
    titles = titles.select(F.col("site").alias("_site"), F.col("category").alias("_category"),
                           F.col("position").alias("_position"), F.col("title_set").alias("titleSet"))
    cond = (base["channelName"].eqNullSafe(titles["_site"])
            & base["entryName"].eqNullSafe(titles["_category"])
            & base["position"].eqNullSafe(titles["_position"]))
    joined = base.join(titles, cond, "left")
    metric_cols = [c for c in base.columns if c not in ("date", "channelName", "entryName", "position", "id_1")]
    return joined.select("date", "channelName", "entryName", "position", "titleSet", "id_1", *metric_cols)


CELL_SETS = HEATMAP_SETS + [["site", "category", "position", "title"]]


def heatmap_cells(clicks: DataFrame, days: Iterable) -> DataFrame:
    """Every count the heat map needs from ONE aggregation (one scan of the logs).

    ``GROUP BY dt, GROUPING SETS((site,category,position), (site,category),
    (site,category,position,title))``; ``_gid`` is the grouping id over
    (dt, site, category, position, title): 1 = cell, 3 = entry subtotal,
    0 = title within a cell. Its size is the number of groups, not of clicks.
    """
    rows = _positions(clicks.where(F.col("dt").isin([iso(d) for d in days])))
    metrics = [F.count("custom_uuid").alias("playNum"), F.count_distinct("custom_uuid").alias("users")]
    return rollup(rows, GROUP_KEYS + ["title"], metrics, sets=CELL_SETS, always=["dt"], id_col="_gid")


def click_heatmap_from_cells(cells: DataFrame, report_day, *, min_count: int = MIN_GROUP_COUNT,
                             title_min_count: int | None = None, k: int = TOP_TITLES, sep: str = "|",
                             baselines: Mapping[str, int] = BASELINES) -> DataFrame:
    """R8 from ``heatmap_cells``.

    Group rows (cells, entry subtotals) pass ``HAVING playNum >= min_count`` on
    every day; title rows of the report day pass the title threshold and are
    ranked per cell by a window over the aggregate. One ``groupBy`` then pivots
    the group rows over the days and lists each cell's top k titles (at most k
    entries, best first; NULL when the cell has none).
    """
    d0 = as_day(report_day)
    title_min = min_count if title_min_count is None else title_min_count
    gid = F.col("_gid")
    title_row = ((gid == 0) & (F.col("dt") == iso(d0)) & F.col("title").isNotNull()
                 & (F.col("playNum") >= F.lit(title_min)))
    group_row = (gid != 0) & (F.col("playNum") >= F.lit(min_count))
    rows = cells.withColumn("_title_row", title_row).where(group_row | F.col("_title_row"))
    rank = Window.partitionBy(*GROUP_KEYS, "_title_row").orderBy(F.col("playNum").desc(),
                                                                 F.col("title").asc_nulls_last())
    rows = (rows.withColumn("_rn", F.row_number().over(rank))
            .where(~F.col("_title_row") | (F.col("_rn") <= F.lit(k)))
            .withColumn("id_1", F.shiftright(gid, 1)))
    titles = F.collect_list(F.when(F.col("_title_row"), F.struct(F.col("_rn"), F.col("title"))))
    title_set = F.when(F.size(titles) > 0,
                       F.concat_ws(sep, F.transform(F.array_sort(titles), lambda x: x["title"])))
    return compare_periods(rows, day_col="dt", report_day=d0,
                           keys={"site": "channelName", "category": "entryName", "position": "position"},
                           metrics=HEATMAP_METRICS, baselines=baselines, day_value=iso,
                           metric_rows=~F.col("_title_row"), extra={"titleSet": title_set})
