"""What changed in a table, for the tables that are derived from it.

A commit with ``track`` (``sources.commits``) names the days it touches twice in
``<table>_changes``: before its partitions are turned and after. A derived table keeps the
commits it has taken in, in ``<derived>_applied``. What is *pending* for it are

* finished commits it hasn't taken in, and
* begun commits without an end (a run that died, or is under way): their days are
  rebuilt until the commit, or a rerun of it, has ended.

There is no clock and no order in this: a commit that ends while a derived table is being
rebuilt stays pending for it. Both tables have one row per commit and day.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BEGUN, ENDED = "begun", "ended"


class Pending(NamedTuple):
    """Days to rebuild, sorted, and the commits that are taken in by that."""

    days: list[str]
    runs: list[str]


def _append(spark: SparkSession, name: str, rows: list[tuple], schema: str) -> None:
    if rows:
        spark.createDataFrame(rows, schema).coalesce(1).write.format("parquet").mode("append").saveAsTable(name)


def note(spark: SparkSession, source: str, run: str, days: Iterable[str | None], phase: str) -> None:
    _append(spark, f"{source}_changes", [(run, d, phase) for d in sorted({d for d in days if d is not None})],
            "run string, day string, phase string")


def changes(spark: SparkSession, source: str) -> DataFrame:
    """(run, day, phase) of every tracked commit of the table."""
    if not spark.catalog.tableExists(f"{source}_changes"):
        return spark.createDataFrame([], "run string, day string, phase string")
    return spark.table(f"{source}_changes")


def pending(spark: SparkSession, source: str, derived: str) -> Pending:
    """What ``derived`` has to take in of ``source``; as many rows as there are commits and days outstanding."""
    log = changes(spark, source)
    if spark.catalog.tableExists(f"{derived}_applied"):
        taken = spark.table(f"{derived}_applied").where(F.col("source") == source).select("run").distinct()
        log = log.join(taken, "run", "left_anti")
    rows = log.groupBy("run", "day").agg(F.max(F.col("phase") == ENDED).alias("ended")).collect()
    return Pending(sorted({r["day"] for r in rows}), sorted({r["run"] for r in rows if r["ended"]}))


def taken_in(spark: SparkSession, source: str, derived: str, runs: Iterable[str]) -> None:
    _append(spark, f"{derived}_applied", [(source, r) for r in sorted(set(runs))], "source string, run string")
