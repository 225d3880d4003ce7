"""Report jobs through the command line, on entity tables in a temp folder."""

import os

import pytest

from conftest import rows
from daybook.cli import main
from daybook.functions.dates import report_days
from daybook.plans import members, sales
from daybook.sources import fixtures as fx
from daybook.sources import tables
from test_sources import write_log_days

SMALL = "/root/testdata/sf0.001"
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def entity_dir(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("entities")
    fx.sales_orders(spark, SF).write.parquet(str(root / "sales_orders"))
    fx.member_orders(spark, SF).write.parquet(str(root / "member_orders"))
    fx.rights(spark, SF).write.parquet(str(root / "rights"))
    fx.accounts(spark, SF).write.parquet(str(root / "accounts"))
    return root


def test_daily_sales_job_publishes_once_per_date(spark, entity_dir, tmp_path):
    out = str(tmp_path / "daily_sales")
    args = ["daily-sales", "--date", "2024-01-30", "--orders", str(entity_dir / "sales_orders"), "--out", out]
    main(args)
    main(args)                                    # rerun: the date is replaced, not appended
    main(["daily-sales", "--date", "2024-01-29", "--orders", str(entity_dir / "sales_orders"), "--out", out])
    stored = spark.read.parquet(out)
    want = sales.daily_sales_report(spark.read.parquet(str(entity_dir / "sales_orders")), fx.EVENTS_DAY)
    assert rows(stored.where("date = 20240130").select(*want.columns)) == rows(want)
    assert {r.date for r in stored.select("date").distinct().collect()} == {20240130, 20240129}


def test_new_members_job(spark, entity_dir, tmp_path):
    out = str(tmp_path / "members")
    main(["new-members", "--date", "1995-07-12", "--by", "account", "--out", out,
          "--orders", str(entity_dir / "member_orders"), "--rights", str(entity_dir / "rights"),
          "--accounts", str(entity_dir / "accounts")])
    want = members.new_members_report(fx.rights(spark, SF), fx.member_orders(spark, SF), fx.accounts(spark, SF),
                                      fx.MEMBERS_DAY, keys=members.BY_ACCOUNT)
    assert rows(spark.read.parquet(out).select(*want.columns)) == rows(want)


def test_monthly_job_overwrites_the_month_table(spark, entity_dir, tmp_path):
    out, fact = str(tmp_path / "monthly"), str(tmp_path / "fact")
    for day in ("2024-01-29", "2024-01-30", "2024-01-30"):
        main(["monthly-sales", "--date", day, "--orders", str(entity_dir / "sales_orders"),
              "--fact", fact, "--out", out])
    want = sales.monthly_sales_cube(tables.read_daily_fact(spark, fact))
    assert rows(spark.read.parquet(out).select(*want.columns)) == rows(want)
    assert tables.read_daily_fact(spark, fact).select("date").distinct().count() == 2


def test_log_jobs(spark, tmp_path):
    logs, stay = str(tmp_path / "logs"), str(tmp_path / "stay")
    d0, d1, d7 = report_days(fx.EVENTS_DAY).values()
    write_log_days(spark, logs, [d0, d1, d7])
    for d in (d7, d1):
        main(["ingest-page-stay", "--date", str(d), "--logs", logs, "--page-stay", stay])
    main(["page-exposure", "--date", str(d0), "--logs", logs, "--page-stay", stay, "--out", str(tmp_path / "exp")])
    main(["heatmap", "--date", str(d0), "--logs", logs, "--min-count", "3", "--title-min-count", "2",
          "--out", str(tmp_path / "heat")])
    assert spark.read.parquet(str(tmp_path / "exp")).count() > 0
    assert spark.read.parquet(str(tmp_path / "heat")).count() > 0
    assert os.path.isdir(os.path.join(stay, "load_date=2024-01-23"))


def test_cli_arguments_and_properties_file(tmp_path):
    from daybook.cli import _properties, parser

    props = tmp_path / "jdbc.properties"
    props.write_text("# credentials\nuser = reporter\npassword=s=cret\n\ndriver=org.example.Driver\n")
    assert _properties(str(props)) == {"user": "reporter", "password": "s=cret", "driver": "org.example.Driver"}
    assert _properties(None) == {}
    args = parser().parse_args(["heatmap", "--date", "2024-01-30", "--logs", "/x", "--out", "/y"])
    assert (args.job, args.min_count, args.tz, args.missing_category) == ("heatmap", None, "UTC", None)
    args = parser().parse_args(["heatmap", "--date", "2024-01-30", "--title-min-count", "2",
                                "--missing-category", ""])
    assert (args.title_min_count, args.missing_category or None) == (2, None)
    with pytest.raises(SystemExit):
        parser().parse_args(["unknown-job", "--date", "2024-01-30"])
