"""CUBE / GROUPING SETS metrics with a grouping id.

``rollup`` always groups by ``always`` (e.g. the day) and rolls up ``keys``
with a CUBE or explicit grouping sets. ``grouping_id()`` covers
``always + keys`` in that order; the ``always`` columns are never rolled up, so
their bits are 0 and the id equals the id of the keys-only cube (first key =
highest bit, 1 = rolled up). That lets several days be cubed in one pass and
one shuffle instead of one cube per day.

Exact ``count_distinct`` is planned by Spark as a two-phase aggregate: the first
shuffle is keyed by (group, distinct value), so a grand-total group holding most
rows is still spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cube_sets(keys: Sequence[str]) -> list[list[str]]:
    """All subsets of ``keys``, largest first (the sets of ``CUBE(keys)``)."""
    keys = list(keys)
    return [list(c) for n in range(len(keys), -1, -1) for c in combinations(keys, n)]


def rollup(df: DataFrame, keys: Sequence[str], metrics: Sequence[Column], *,
           sets: Sequence[Sequence[str]] | None = None, always: Sequence[str] = (),
           id_col: str = "id_1", having: Column | None = None) -> DataFrame:
    """``GROUP BY always, CUBE(keys)`` (or ``GROUPING SETS(sets)``) with ``id_col``.

    ``having`` filters the aggregated rows (it may name metric aliases).
    """
    always = list(always)
    group_sets = cube_sets(keys) if sets is None else [list(s) for s in sets]
    spec = [always + s for s in group_sets]
    out = df.groupingSets(spec, *(always + list(keys))).agg(
        F.grouping_id().alias(id_col), *metrics)
    return out.where(having) if having is not None else out
