"""Top-k labels per group (C5) and the unordered top-k label set (A10).

Counts per (group, label) combine map-side; ``row_number() <= k`` lets Spark
insert ``WindowGroupLimit`` before and after the shuffle, so each task ships at
most k rows per group however many labels a hot group has. The final list
holds at most k entries. Ties in the count are broken by the label (NULL last)
so the result is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _count(df: DataFrame, keys: Sequence[str], label: str, count_of: str, min_count: int,
           count_name: str) -> DataFrame:
    return (df.groupBy(*keys, label).agg(F.count(count_of).alias(count_name))
            .where(F.col(count_name) >= F.lit(min_count)))


def _top_rows(counted: DataFrame, keys: Sequence[str], label: str, count_col: str, k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col(count_col).desc(), F.col(label).asc_nulls_last())
    return counted.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= F.lit(k))


def top_k_labels(df: DataFrame, keys: Sequence[str], label: str, *, count_of: str, k: int = 3,
                 min_count: int = 1, sep: str = "|", out_col: str = "title_set",
                 count_name: str = "playNum") -> DataFrame:
    """``keys`` + ``out_col``: the k most counted non-NULL labels, best first, joined by ``sep``.

    ``count(count_of)`` counts non-NULL values; labels below ``min_count`` are skipped.
    """
    counted = _count(df.where(F.col(label).isNotNull()), keys, label, count_of, min_count, count_name)
    return rank_labels(counted, keys, label, count_name, k=k, sep=sep, out_col=out_col)


def rank_labels(counted: DataFrame, keys: Sequence[str], label: str, count_col: str, *, k: int = 3,
                sep: str = "|", out_col: str = "title_set") -> DataFrame:
    """Top-k of already counted ``(keys, label, count_col)`` rows, best first."""
    ranked = _top_rows(counted, keys, label, count_col, k)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(F.col("_rn"), F.col(label)))),
                          lambda x: x[label])
    return ranked.groupBy(*keys).agg(F.concat_ws(sep, ordered).alias(out_col))


def top_k_label_set(df: DataFrame, keys: Sequence[str], label: str, *, count_of: str, k: int = 3,
                    min_count: int = 1, sep: str = "|", out_col: str = "title_set",
                    count_name: str = "playNum") -> DataFrame:
    """Set form: a NULL label may take one of the k ranks, then is left out;
    the surviving labels are sorted alphabetically."""
    ranked = _top_rows(_count(df, keys, label, count_of, min_count, count_name), keys, label, count_name, k)
    return ranked.groupBy(*keys).agg(
        F.concat_ws(sep, F.array_sort(F.collect_set(F.col(label)))).alias(out_col))
