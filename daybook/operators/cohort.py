"""First-seen cohorts.

Per report day ``d`` the reference keeps the rows of ``d`` whose key group has
no earlier row: ``min(time) over (partition by keys)`` on rows ``<= d``, kept
where the minimum equals ``d``. Because a row after ``d`` cannot lower a
minimum, the same rows follow from ONE minimum per key for all report days at
once: keep rows where ``time = first`` and ``first`` is a report day.

Both forms read their input once. A map-side combined hash aggregation first
collapses a key's history to its earliest day; a window over what is left (rows of
the report days, or bounded label combinations) then compares with the minimum. A
key holding a third of all rows thus reaches the window as one history row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_seen(df: DataFrame, keys: Sequence[str], time_col: str, days: Iterable, *,
               out_col: str = "registtime") -> DataFrame:
    """Rows first seen on one of ``days``, tagged with ``out_col`` = that day.

    ``time_col`` must be comparable with the ``days`` literals (DATE columns with
    ``datetime.date`` values). Rows after the last day are ignored, as the
    reference's day-bounded pull does. Rows off the report days only matter through
    their key's minimum, so they are grouped to one row per key; equal rows of the
    report days are grouped with a count and come back that many times.
    """
    days = sorted(set(days))
    history = df.where(F.col(time_col) <= F.lit(days[-1]))
    on_days = F.col(time_col).isin(days)
    others = [c for c in df.columns if c not in keys]
    grouped = (history.groupBy(*keys, on_days.alias("_on"),
                               *[F.when(on_days, F.col(c)).alias(f"_c{i}") for i, c in enumerate(others)])
               .agg(F.min(time_col).alias("_day"), F.count("*").alias("_n")))
    tagged = grouped.withColumn(out_col, F.min("_day").over(Window.partitionBy(*keys)))
    rows = tagged.where(F.col("_on") & (F.col("_day") == F.col(out_col)))
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
    column = {c: F.col(f"_c{i}").alias(c) for i, c in enumerate(others)}
    return rows.select(*[column.get(c, c) for c in df.columns], out_col)


def first_seen_groups(df: DataFrame, keys: Sequence[str], time_col: str, days: Iterable,
                      carry: Sequence[str], *, out_col: str = "registtime") -> DataFrame:
    """Distinct ``keys + carry`` combinations first seen on one of ``days``.

    Same rows as ``first_seen(...).select(keys, carry, out_col).distinct()``: one hash
    aggregation finds the first day of every combination, and a combination is kept
    where that is the first day of its key. A key has at most as many rows in the
    window as there are ``carry`` combinations, so ``carry`` must be label columns (a
    bounded vocabulary such as channel and package labels), never ids.
    """
    days = sorted(set(days))
    extra = [c for c in carry if c not in keys]
    first = (df.where(F.col(time_col) <= F.lit(days[-1]))
             .groupBy(*keys, *extra).agg(F.min(time_col).alias("_day")))
    tagged = first.withColumn(out_col, F.min("_day").over(Window.partitionBy(*keys)))
    return (tagged.where((F.col("_day") == F.col(out_col)) & F.col(out_col).isin(days))
            .select(*keys, *extra, out_col))
