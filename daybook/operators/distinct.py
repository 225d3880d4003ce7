"""Mergeable exact distinct counts: bitmaps over dictionary-coded values.

``count_distinct`` can't be added up: users of two days are not the sum of the users of
each. A bitmap of coded users can: it is built once when a day is loaded, and any
period, grouping set or cube level is the bitwise OR of the stored ones.

* The dictionary gives every value a lasting number, dense enough for bitmaps. Values
  are dealt to ``LANES`` lanes by a hash; within its lane a new value gets the next rank, and its
  code is ``rank * LANES + lane + 1``. No sort or counter spans all values, and codes that
  were given never change.
* A bitmap covers 32,768 codes (4 KB, mostly zeros for a small group, which files and
  shuffles compress); a group has one for each bucket of codes it holds.
* Counting a group is the sum of the bit counts of its buckets, so a report shuffles
  (group, bucket) rows and no values at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rollup import cube_sets

LANES = 1024
CODE, BUCKET, MEMBERS = "code", "bucket", "members"


def empty_codes(like: DataFrame, value: str) -> DataFrame:
    return like.select(F.col(value), F.lit(0).cast("long").alias(CODE)).limit(0)


def new_codes(values: DataFrame, value: str, codes: DataFrame, *, lanes: int = LANES) -> DataFrame:
    """(value, code) of the values that ``codes`` doesn't know; NULL gets no code."""
    known = codes.select(F.col(value).alias("_known"))
    fresh = values.select(value).where(F.col(value).isNotNull()).distinct()
    fresh = fresh.join(known, F.col(value) == F.col("_known"), "left_anti")
    fresh = fresh.withColumn("_lane", F.pmod(F.xxhash64(value), F.lit(lanes)))
    # one row a lane: the ranks it has given so far
    given = codes.groupBy(F.pmod(F.col(CODE) - 1, F.lit(lanes)).alias("_lane")).agg(
        (F.max(F.floor((F.col(CODE) - 1) / lanes)) + 1).alias("_given"))
    ranked = fresh.withColumn("_rank", F.row_number().over(Window.partitionBy("_lane").orderBy(value)) - 1)
    rank = F.coalesce("_given", F.lit(0)) + F.col("_rank")
    return ranked.join(given, "_lane", "left").select(value, (rank * lanes + F.col("_lane") + 1).cast("long").alias(CODE))


def bitmap_rows(df: DataFrame, keys: Sequence[str], value: str, codes: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """(keys, bucket, members, sums): what is stored. One row per group and bucket of codes.

    ``df`` should hold a value once per group (pre-aggregated): then a value with a third of
    all rows meets the dictionary once per group. Rows without the value are in bucket 0, with no
    member. ``sums`` are added up beside the bitmaps.
    """
    known = codes.select(F.col(value).alias("_value"), F.col(CODE).alias("_code"))
    coded = df.join(known, F.col(value) == F.col("_value"), "left")
    return (coded.groupBy(*keys, F.coalesce(F.bitmap_bucket_number("_code"), F.lit(0)).cast("long").alias(BUCKET))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_code")).alias(MEMBERS),
                 *(F.sum(c).alias(n) for n, c in sums.items())))


def merged_counts(rows: DataFrame, keys: Sequence[str], sums: Sequence[str], *, always: Sequence[str] = (),
                  sets: Sequence[Sequence[str]] | None = None, id_col: str = "id_1", count: str = "users") -> DataFrame:
    """``GROUP BY always, CUBE(keys)`` (or grouping sets) over stored rows: exact distinct counts and sums.

    The id is that of ``always + keys``, as in ``operators.rollup``.
    """
    always = list(always)
    wanted = [list(s) for s in (cube_sets(keys) if sets is None else sets)]
    spec = [[*always, BUCKET, *s] for s in wanted]
    # the bucket is never rolled up and stands before the keys: its bit is 0 and the id that of always + keys
    grouped = rows.groupingSets(spec, *always, BUCKET, *keys).agg(
        F.grouping_id().alias(id_col), F.bitmap_count(F.bitmap_or_agg(MEMBERS)).alias("_n"), *(F.sum(s).alias(s) for s in sums))
    return (grouped.groupBy(*always, *keys, id_col)
            .agg(F.sum("_n").alias(count), *(F.sum(s).alias(s) for s in sums)))
