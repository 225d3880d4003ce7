"""Time the reference-shaped plans against the single-pass rewrites.

X1 first-seen: three per-day window passes (rows <= d, min over keys, keep = d),
   three cubes, two joins   vs   one aggregate + join for all days, one cube, pivot.
X2 comparison: three per-day cubes and two null-safe left joins   vs   one cube
   grouped by day and a pivot.
X3 heat map: grouping sets and top titles read separately, then joined   vs   one
   aggregation with a title-level grouping set, a window and one pivot.

Prints one JSON line: {"x1": {"reference": s, "rewrite": s}, "x2": {...}, "x3": {...}, "sf": ...}.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from daybook.functions.dates import report_days  # noqa: E402
from daybook.functions.presets import fixture_packages  # noqa: E402
from daybook.operators.compare import compare_frames  # noqa: E402
from daybook.plans import catalog, exposure, heatmap, members  # noqa: E402
from daybook.plans.exposure import EXPOSURE_METRICS  # noqa: E402
from daybook.session import local_session  # noqa: E402
from daybook.sources import fixtures as fx  # noqa: E402

MEMBER_METRICS = {"totalUserCount": ("totalUserCount", "userCount")}
MEMBER_KEYS = {"channelName": "channelName", "packageName": "packageName"}


def timed(build, repeat):
    build().write.format("noop").mode("overwrite").save()
    out = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        out.append(time.perf_counter() - t0)
    return round(statistics.median(out), 4)


def members_reference(spark, sf):
    labeled = members.label_members(catalog._pull(spark, sf, with_right_days=False), fixture_packages())
    per_day = {}
    for suffix, d in report_days(fx.MEMBERS_DAY).items():
        w = Window.partitionBy(*members.BY_CHANNEL)
        first = (labeled.where(F.col("order_addtime") <= F.lit(d))
                 .withColumn("registtime", F.min("order_addtime").over(w))
                 .where(F.col("registtime") == F.lit(d)))
        per_day[suffix] = first.cube("channelName", "packageName").agg(
            F.grouping_id().alias("id_1"), F.count_distinct("account_name").alias("totalUserCount"))
    return compare_frames(per_day[""], {"Day": per_day["Day"], "Week": per_day["Week"]},
                          report_day=fx.MEMBERS_DAY, keys=MEMBER_KEYS, metrics=MEMBER_METRICS)


def exposure_reference(spark, sf):
    days = report_days(fx.EVENTS_DAY)
    stays = exposure.page_stay_rows(fx.launcher_logs(spark, sf, days.values()))
    per_day = {s: exposure.exposure_cube(stays, [d]).drop("dt") for s, d in days.items()}
    return compare_frames(per_day[""], {"Day": per_day["Day"], "Week": per_day["Week"]},
                          report_day=fx.EVENTS_DAY, keys={"site": "channelName", "title": "typeName"},
                          metrics=EXPOSURE_METRICS)


def heatmap_joined(spark, sf):
    days = report_days(fx.EVENTS_DAY)
    clicks = heatmap.click_rows(fx.launcher_logs(spark, sf, days.values()))
    return heatmap.click_heatmap_report_one_pass(clicks, fx.EVENTS_DAY, min_count=fx.FIXTURE_MIN_GROUP,
                                               title_min_count=fx.FIXTURE_MIN_TITLE)


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cores=int(os.environ.get("BENCH_CPUS", "8")), call_site_context=False)
    result = {
        "x1": {"reference": timed(lambda: members_reference(spark, sf), repeat),
               "rewrite": timed(lambda: catalog.new_members_report(spark, sf), repeat)},
        "x2": {"reference": timed(lambda: exposure_reference(spark, sf), repeat),
               "rewrite": timed(lambda: catalog.page_exposure_report(spark, sf), repeat)},
        "x3": {"reference": timed(lambda: heatmap_joined(spark, sf), repeat),
               "rewrite": timed(lambda: catalog.click_heatmap_report(spark, sf), repeat)},
        "sf": sf,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
