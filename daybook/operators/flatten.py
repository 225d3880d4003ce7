"""Nested event flattening (C6): one row per element of an array of structs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flatten_events(df: DataFrame, array_path: str, fields: Sequence[str] | Mapping[str, str], *,
                   keep: Sequence[str | Column] = (), not_null: Sequence[str] = ("time",),
                   fill: Mapping[str, Column] | None = None) -> DataFrame:
    """Explode ``array_path`` and lift the element ``fields`` to columns.

    Records whose array is NULL or empty yield no rows (plain ``explode``).
    Elements with NULL in any of ``not_null`` are dropped. ``fields`` may map
    element field -> output name. ``fill`` replaces NULL fields with a value
    (schema-drift guard: with an explicit read schema an absent field is NULL).
    Only the referenced fields are read from columnar sources (nested pruning).
    """
    mapping = dict(fields) if isinstance(fields, Mapping) else {f: f for f in fields}
    # With a not-null element filter, explode_outer + that filter yields exactly
    # explode's rows (a NULL/empty array gives one NULL element, which the filter
    # drops). It avoids the inferred ``size(array) > 0`` filter that Catalyst
    # pushes below the projection, re-evaluating a computed array per row.
    gen = F.explode_outer if not_null else F.explode
    exploded = df.select(*keep, gen(F.col(array_path)).alias("_e"))
    for f in not_null:
        exploded = exploded.where(F.col(f"_e.{f}").isNotNull())
    fill = fill or {}
    lifted = []
    for src, out in mapping.items():
        c = F.col(f"_e.{src}")
        if src in fill:
            c = F.coalesce(c, fill[src])
        lifted.append(c.alias(out))
    kept = [F.col(c) for c in exploded.columns if c != "_e"]
    return exploded.select(*kept, *lifted)
