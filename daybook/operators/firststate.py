"""Persisted first-seen state (C2, W1, W2 made incremental).

The state holds, for every key, its first day and the label combinations of that
day: the rows of ``first_seen_groups`` for all days at once. It is partitioned by
``first_day``, so a report day is a handful of partitions.

``merge_first_seen`` takes the rows that have become known since, of any days, and
gives the partitions that change, whole:

* a key that is new, or whose rows are of its first day, adds combinations to that day;
* a key seen earlier than the state knows (a late order) moves: its rows leave the
  partition of the former first day and the earlier day gets its combinations;
* rows after a key's first day change nothing.

Merging is idempotent and does not depend on the order of merges, so a rerun or a late
file is merged like any other. What it can't see is a row that is taken back (an order
cancelled after its day): ``correct_first_seen`` replaces the state of given keys by what
their whole remaining history says.

Keys are compared null-safely. The state is shuffled by key only against the keys of
the new rows (a semi-join Spark broadcasts where they are few); a key with a third of
all rows is one group after the map-side aggregation.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FIRST_DAY = "first_day"


class StateChange(NamedTuple):
    """The partitions (first days) that change, and all the rows they hold afterwards."""

    days: list
    rows: DataFrame


def state_rows(rows: DataFrame, keys: Sequence[str], time_col: str, carry: Sequence[str] = ()) -> DataFrame:
    """(keys, carry, first_day): the state that ``rows`` alone give. ``carry`` must be label columns."""
    extra = [c for c in carry if c not in keys]
    first = rows.groupBy(*keys, *extra).agg(F.min(time_col).alias("_day"))
    tagged = first.withColumn(FIRST_DAY, F.min("_day").over(Window.partitionBy(*keys)))
    return tagged.where(F.col("_day") == F.col(FIRST_DAY)).select(*keys, *extra, FIRST_DAY)


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[f"_{k}"])
    return cond


def _named(df: DataFrame, keys: Sequence[str], **more: str) -> DataFrame:
    """The keys under names of their own, so that a join's two sides can't be confused."""
    return df.select(*(F.col(k).alias(f"_{k}") for k in keys), *(F.col(c).alias(n) for n, c in more.items()))


def merge_first_seen(state: DataFrame, rows: DataFrame, keys: Sequence[str], time_col: str, carry: Sequence[str] = (),
                     *, cut: Callable[[DataFrame], DataFrame]) -> StateChange:
    """Merge rows into a state; ``cut`` materialises a small intermediate that is used several times."""
    new = state_rows(rows, keys, time_col, carry)
    asked = _named(new, keys).distinct()
    known = (state.join(asked, _same(state, asked, keys), "left_semi")
             .groupBy(*keys).agg(F.min(FIRST_DAY).alias("_old")))
    known = _named(known, keys, _old="_old")
    joined = cut(new.join(known, _same(new, known, keys), "left").select(*new.columns, "_old"))
    add = joined.where(F.col("_old").isNull() | (F.col(FIRST_DAY) <= F.col("_old"))).select(*state.columns)
    moved = joined.where(F.col(FIRST_DAY) < F.col("_old"))
    return _changed(state, add, _named(moved, keys, _old="_old").distinct(), keys)


def correct_first_seen(state: DataFrame, wrong: DataFrame, history: DataFrame, keys: Sequence[str], time_col: str,
                       carry: Sequence[str] = (), *, cut: Callable[[DataFrame], DataFrame]) -> StateChange:
    """Replace the state of the keys in ``wrong`` by that of ``history``, all their rows that still count."""
    asked = _named(wrong, keys).distinct()
    add = cut(state_rows(history, keys, time_col, carry).join(
        asked, _same(history, asked, keys), "left_semi").select(*state.columns))
    gone = cut(state.join(asked, _same(state, asked, keys), "left_semi"))
    return _changed(state, add, _named(gone, keys, _old=FIRST_DAY).distinct(), keys)


def _changed(state: DataFrame, add: DataFrame, gone: DataFrame, keys: Sequence[str]) -> StateChange:
    """The partitions that ``add`` and ``gone`` touch, at most one per calendar day."""
    touched = add.select(FIRST_DAY).union(gone.select("_old")).distinct()
    days = sorted(r[0] for r in touched.collect())
    held = state.where(F.col(FIRST_DAY).isin(days) if days else F.lit(False))
    stay = held.join(gone, _same(held, gone, keys) & (held[FIRST_DAY] == gone["_old"]), "left_anti")
    return StateChange(days, stay.unionByName(add).distinct())
