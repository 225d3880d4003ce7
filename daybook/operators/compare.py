"""Period-over-period comparison (C4).

The report row set is "every group of the report day", each with its metrics
and the change against the same group on baseline days (left outer semantics:
a group missing on a baseline gives NULL changes; a group only on a baseline
is dropped). Group keys are compared NULL-safely, so a genuine NULL key and a
rolled-up key never mix (``id_1`` separates them) and no sentinel value can
collide with a real key.

Two forms:

* ``compare_periods`` takes ONE per-day aggregate (``day`` column + keys + id)
  and pivots it with a single small ``groupBy``; no join at all. This is the
  form the reports use: the days come from one scan and one cube.
* ``compare_frames`` takes separate current / baseline aggregates and joins them
  with null-safe equi-joins (for inputs that only exist per day).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import BASELINES, as_day, date_key, report_days
from ..functions.metrics import pct_change


def _names(metric: str, spec) -> tuple[str, str]:
    """(total column name, compare prefix) for a metric."""
    if isinstance(spec, str):
        return spec, metric
    return spec[0], spec[1]


def compare_periods(rolled: DataFrame, *, day_col: str, report_day, keys: Mapping[str, str],
                    metrics: Mapping[str, tuple[str, str] | str], id_col: str = "id_1",
                    baselines: Mapping[str, int] = BASELINES, day_value=None,
                    metric_rows: Column | None = None, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Pivot a per-day aggregate into the report rows of ``report_day``.

    ``keys`` maps source key -> output name, ``metrics`` maps source metric ->
    (total name, compare prefix); each metric yields ``total``,
    ``<prefix>Compare<Baseline>`` for every baseline. ``day_value`` converts a
    Python day to the literal stored in ``day_col`` (default: the date itself).
    ``metric_rows`` restricts which input rows carry metrics and presence (the
    others may feed ``extra``: output name -> aggregate over the group's rows,
    placed after the keys).
    """
    days = report_days(report_day, baselines)
    lit_of = day_value or (lambda d: d)
    day = F.col(day_col)
    counted = metric_rows if metric_rows is not None else F.lit(True)
    aggs: list[Column] = [F.bool_or((day == F.lit(lit_of(days[""]))) & counted).alias("_on_report_day")]
    for m in metrics:
        for suffix, d in days.items():
            aggs.append(F.max(F.when((day == F.lit(lit_of(d))) & counted, F.col(m))).alias(f"{m}@{suffix}"))
    extra = dict(extra or {})
    aggs += [col.alias(name) for name, col in extra.items()]
    wide = (rolled.where(day.isin([lit_of(d) for d in days.values()]))
            .groupBy(*keys, id_col).agg(*aggs).where(F.col("_on_report_day")))
    return wide.select(*_report_columns(days, keys, metrics, id_col, lambda m, s: F.col(f"{m}@{s}"),
                                        extra=list(extra)))


def compare_frames(current: DataFrame, baselines: Mapping[str, DataFrame], *, report_day,
                   keys: Mapping[str, str], metrics: Mapping[str, tuple[str, str] | str],
                   id_col: str = "id_1") -> DataFrame:
    """Join form: ``current`` left-joined to each baseline on null-safe keys + id."""
    out = current.alias("t0")
    for suffix, base in baselines.items():
        cond = F.col(f"t0.{id_col}") == F.col(f"t{suffix}.{id_col}")
        for k in keys:
            cond = cond & F.col(f"t0.{k}").eqNullSafe(F.col(f"t{suffix}.{k}"))
        out = out.join(base.alias(f"t{suffix}"), cond, "left")
    days = {"": as_day(report_day), **{s: None for s in baselines}}

    def metric(m: str, suffix: str) -> Column:
        return F.col(f"t0.{m}") if suffix == "" else F.col(f"t{suffix}.{m}")

    renamed = {f"t0.{k}": v for k, v in keys.items()}
    return out.select(*_report_columns(days, renamed, metrics, f"t0.{id_col}", metric,
                                       id_alias=id_col))


def _report_columns(days: Mapping, keys: Mapping[str, str], metrics: Mapping, id_col: str,
                    value, id_alias: str | None = None, extra: list[str] | None = None) -> list[Column]:
    cols = [F.lit(date_key(days[""])).cast("int").alias("date")]
    cols += [F.col(k).alias(v) for k, v in keys.items()]
    cols += [F.col(name) for name in extra or []]
    cols.append(F.col(id_col).alias(id_alias or id_col))
    for m, spec in metrics.items():
        total, prefix = _names(m, spec)
        cols.append(value(m, "").alias(total))
        for suffix in days:
            if suffix:
                cols.append(pct_change(value(m, ""), value(m, suffix)).alias(f"{prefix}Compare{suffix}"))
    return cols
