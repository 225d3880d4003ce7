"""Command line: run one report job for a date (what a scheduler calls daily).

    python -m daybook <job> --date YYYY-MM-DD [inputs] --out PATH [--jdbc-url ...]

Inputs are file tables (``--input-format``, default parquet) with the entity
columns of the reports: orders (order_id, account_id, order_type, order_status,
order_state, order_price, order_provide, package_id, order_addtime,
order_delevetime), rights (order_id, package_provide, right_starttime,
right_limitdate), accounts (account_id, account_name, account_addtime); launcher
logs are gzip JSON day folders. The session comes from spark-submit.
JDBC credentials are read from a properties file (``key=value`` lines), never
from the command line.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, Observation, SparkSession

from .functions.dates import iso
from .plans import audience, jobs, launcher, members, memberstate, sales
from .sources import jdbc, tables


def _properties(path: str | None) -> dict[str, str]:
    if not path:
        return {}
    out = {}
    with open(path) as fh:
        for line in fh:
            line = line.strip()
            if line and not line.startswith("#") and "=" in line:
                key, value = line.split("=", 1)
                out[key.strip()] = value.strip()
    return out


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m daybook", description=__doc__.split("\n\n")[0])
    p.add_argument("job", choices=["ingest-page-stay", "ingest-logs", "page-exposure", "weekly-exposure", "heatmap",
                                   "update-audience", "refresh-exposures", "daily-sales", "daily-fact", "monthly-sales", "update-members",
                                   "new-members"])
    p.add_argument("--date", required=True, help="report date (yyyy-MM-dd)")
    p.add_argument("--tz", default="UTC", help="zone of the report days")
    p.add_argument("--logs", help="root of the launcher log day folders")
    p.add_argument("--page-stay", help="page-stay table path or name")
    p.add_argument("--clicks", help="catalog table of clicks (ingest-logs writes it, heatmap reads it instead of logs)")
    p.add_argument("--runs", help="shared folder for the files of ingest-logs")
    p.add_argument("--audience", help="catalog table of stored audiences (update-audience writes it, the exposure reports read it)")
    p.add_argument("--state", help="catalog table of the first-seen state (update-members writes it, new-members reads it)")
    p.add_argument("--order-days", default="", help="update-members, monthly-sales of catalog tables: further order days "
                   "to read (late or corrected orders), yyyy-MM-dd,yyyy-MM-dd")
    p.add_argument("--orders"), p.add_argument("--rights"), p.add_argument("--accounts")
    p.add_argument("--fact", help="daily order fact table path")
    p.add_argument("--by", choices=["channel", "account"], default="channel", help="new-member cohort key")
    p.add_argument("--min-count", type=int, default=None, help="heat map HAVING threshold")
    p.add_argument("--title-min-count", type=int, default=None, help="heat map title threshold")
    p.add_argument("--missing-category", default=None,
                   help="heat map label of a click without category (default: it stays NULL)")
    p.add_argument("--input-format", default="parquet",
                   help="format of the input tables; 'table' reads catalog tables by name")
    p.add_argument("--input-jdbc-url", help="read --orders, --rights and --accounts as tables of this database")
    p.add_argument("--input-jdbc-properties", help="file with user=, password=, driver= lines")
    p.add_argument("--input-jdbc-partitions", type=int, default=None,
                   help="parallel reads per table, split on its id column between the two bounds")
    p.add_argument("--input-jdbc-bounds", default=None, help="LOWER:UPPER of the id column")
    p.add_argument("--out", help="report table path (replaced per date)")
    p.add_argument("--jdbc-url"), p.add_argument("--jdbc-table")
    p.add_argument("--jdbc-mode", choices=["overwrite", "append", "swap"], default="overwrite",
                   help="rewrite the exported table, append the report day to it, or replace the day "
                        "(monthly-sales: all rows) from a staging table in one transaction")
    p.add_argument("--jdbc-properties", help="file with user=, password=, driver= lines")
    return p


#: The id column a parallel JDBC read of an input is split on.
ID_COLUMNS = {"orders": "order_id", "rights": "order_id", "accounts": "account_id"}


def read_input(args: argparse.Namespace, spark: SparkSession, name: str) -> DataFrame:
    """The orders, rights or accounts input: a database table, a catalog table or files.

    Day bounds are plain ranges on the epoch columns, which Spark pushes into the
    database's WHERE as well as into files.
    """
    source = getattr(args, name)
    if args.input_jdbc_url:
        split = {}
        if args.input_jdbc_partitions:
            lower, upper = (int(x) for x in (args.input_jdbc_bounds or "").split(":"))
            split = {"partition_column": ID_COLUMNS[name], "lower_bound": lower, "upper_bound": upper,
                     "num_partitions": args.input_jdbc_partitions}
        return jdbc.jdbc_source(spark, args.input_jdbc_url, table=source,
                                properties=_properties(args.input_jdbc_properties), **split)
    if args.input_format == "table":
        return spark.table(source)
    return spark.read.format(args.input_format).load(source)


def _say(counts: dict) -> None:
    print(" ".join(f"{k}={v}" for k, v in counts.items()), file=sys.stderr)


def run(args: argparse.Namespace, spark: SparkSession) -> None:
    read = lambda name: read_input(args, spark, name)
    if args.job == "ingest-page-stay":
        counts = jobs.ingest_page_stay(spark, args.logs, args.page_stay, args.date, tz=args.tz)
        _say(counts)
        return
    keys = members.BY_ACCOUNT if args.by == "account" else members.BY_CHANNEL
    if args.job == "ingest-logs":
        _say(launcher.ingest_logs(spark, args.logs, args.page_stay, args.clicks, args.runs, args.date, tz=args.tz))
        return
    if args.job == "update-audience":
        audience.update_audience(spark, args.page_stay, args.audience, args.date)
        return
    if args.job == "update-members":
        days = memberstate.update_members(spark, read("rights"), read("orders"), read("accounts"), args.state, args.date,
                                          keys=keys, order_days=[d for d in args.order_days.split(",") if d], tz=args.tz)
        _say({"changed": ",".join(days)})
        return
    if args.job == "refresh-exposures":
        _say({"built": ",".join(map(iso, audience.refresh_exposures(spark, args.audience, args.out, args.date)))})
        return
    if args.job == "monthly-sales" and tables.is_catalog_name(args.fact) and tables.is_catalog_name(args.out):
        days = [args.date, *(d for d in args.order_days.split(",") if d)]
        _say({"months": ",".join(jobs.update_monthly_sales(spark, read("orders"), args.fact, args.out, days, tz=args.tz))})
        return
    day, watch = args.date, None
    if args.job == "page-exposure" and args.audience:
        report = audience.exposure_report(spark.table(args.audience), args.date)
    elif args.job == "weekly-exposure":
        report = audience.weekly_exposure_report(spark.table(args.audience), args.date)
    elif args.job == "page-exposure":
        report = jobs.page_exposure_job(spark, args.logs, args.page_stay, args.date, tz=args.tz)
    elif args.job == "heatmap":
        extra = {"min_count": args.min_count} if args.min_count is not None else {}
        extra |= {"title_min_count": args.title_min_count, "missing_category": args.missing_category}
        if args.clicks:
            report = launcher.stored_heatmap(spark, args.clicks, args.date, **extra)
        else:
            watch = Observation("records")
            report = jobs.heatmap_job(spark, args.logs, args.date, watch=watch, **extra)
    elif args.job == "daily-sales":
        report = sales.daily_sales_report(read("orders"), args.date, tz=args.tz)
    elif args.job == "daily-fact":
        report = sales.daily_order_fact(read("orders"), args.date, tz=args.tz)
    elif args.job == "monthly-sales":
        report = jobs.monthly_sales_job(spark, read("orders"), args.fact, args.date, tz=args.tz)
        day = None
    elif args.state:
        report = memberstate.state_report(spark.table(args.state), args.date)
    else:
        report = members.new_members_report(read("rights"), read("orders"), read("accounts"),
                                            args.date, keys=keys, tz=args.tz)
    jobs.publish_report(spark, report, args.out, report_day=day, jdbc_url=args.jdbc_url, jdbc_table=args.jdbc_table,
                        jdbc_properties=_properties(args.jdbc_properties), jdbc_mode=args.jdbc_mode)
    if watch is not None:
        _say(watch.get)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    # batch jobs: no web UI (stage times come from the event log)
    spark = (SparkSession.builder.appName(f"daybook-{args.job}")
             .config("spark.ui.enabled", "false").getOrCreate())
    run(args, spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
