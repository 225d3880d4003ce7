"""Label maps (CASE WHEN built from a preset)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .presets import LabelPreset


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def label_map(col: str | Column, preset: LabelPreset,
              fallback: list[tuple[Column, str]] | tuple = ()) -> Column:
    """Map codes to labels; first match wins.

    ``fallback`` adds ``(condition, label)`` branches tried after the codes and
    before the preset default (e.g. "order_type = 3 -> single title"). Without a
    default the unmatched value is NULL. Stays a native CASE expression, so it is
    code-generated and pushes no Python into the plan.
    """
    key = _col(col) if preset.case_sensitive else F.lower(_col(col))
    expr = None
    for label, codes in preset.pairs:
        cond = key == codes[0] if len(codes) == 1 else key.isin(list(codes))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    for cond, label in fallback:
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    if preset.default is not None:
        expr = F.lit(preset.default) if expr is None else expr.otherwise(preset.default)
    return expr if expr is not None else F.lit(None).cast("string")


def override(col: str | Column, cond: Column, label: str) -> Column:
    """``label`` where ``cond`` holds, else the column (gift orders, P5)."""
    return F.when(cond, F.lit(label)).otherwise(_col(col))
