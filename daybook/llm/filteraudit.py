"""Operator 11: interaction audit of document filters.

Every document becomes one *mask* of the five filters that it fails. Documents of
one part with one mask and the same labels are a *cell*, a row with three weights;
there are at most 32 cells to a part. Each cell then folds its mask, with
``transform`` and ``aggregate``, across the array of all 120 filter orders: the
accumulator is whether the documents of the cell are still there, and every step
of every order gives one struct, 600 to a cell, weighted by the cell's counts. The
cells of a part are merged by sums element by element, map-side first.

Failure conditions: ``A`` under 200 words; ``B`` 100 * distinct words < 50 * words;
``C`` 100 * ``[A-Z]`` > 2 * code points; ``D`` any of ``[#$%&*|]``; ``E`` a row of a
smaller id has the same text. Only a digest of the text is shuffled for ``E``,
and the join that looks up the smallest id of repeated texts is salted, as one
text may be a third of all rows.

Edge cases: null text is the empty text (it fails A and, beside a smaller id with
an empty text, E). A null id is neither smaller nor larger than another, so such
rows neither fail E nor make others fail. Rows of one id do not make each other
fail E; repeated rows each count. Several labels of one document: quality 1
counts if any of them has it, so does toxic 1; documents without a label are
neither. Null ids in labels are dropped. An empty table has no parts and gives no
rows. Only the named columns are read, others can't clash.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import cut, salted_left_join

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITALS_PERCENT = 2
SALTS = 8
#: Every order of the filters, as positions in ``FILTERS``.
ORDERS = [list(p) for p in itertools.permutations(range(len(FILTERS)))]

_CAPITALS = bytes(range(65, 91))
_SYMBOL = re.compile(rb"[#$%&*|]")


def text_mask(text: bytes, code_points: int) -> int:
    """Bit k is set where the text alone fails filter k (A to D)."""
    words = text.split()                  # on bytes: exactly the white space \x20 and \x09-\x0D
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return ((len(words) < MIN_WORDS)
            | (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)) << 1
            | (100 * capitals > MAX_CAPITALS_PERCENT * code_points) << 2
            | (_SYMBOL.search(text) is not None) << 3)


def text_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(doc_id, part, mask, digest) of every row; the digest stands for the whole text."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            column = batch.column("text")
            masks, digests = np.zeros(len(column), np.int32), []
            for k, value in enumerate(column):
                text = value.as_buffer().to_pybytes()
                # every byte but those that continue a character begins a code point
                points = len(text) if text.isascii() else len(str(text, "utf-8", "replace"))
                masks[k] = text_mask(text, points)
                digests.append(hashlib.sha256(text).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), pa.array(masks), pa.array(digests, pa.binary())],
                ["doc_id", "part", "mask", "digest"])
    return rows.mapInArrow(batches, "doc_id long, part string, mask int, digest binary")


def cells(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """(part, mask, n, good, toxic): the documents of each part that fail the same filters."""
    masks = cut(text_masks(docs, **columns))
    first = (masks.where("doc_id is not null").groupBy("digest")
             .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
             .where("first <> last").select("digest", "first"))
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic")
             .where("doc_id is not null").groupBy("doc_id")
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("is_good"),
                  F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("is_toxic")))
    # Spark's estimate of the salted labels is the size of their file, not of SALTS rows a label: never broadcast
    rows = salted_left_join(salted_left_join(masks, first, ["digest"], SALTS), known.hint("merge"), ["doc_id"], SALTS)
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return (rows.groupBy("part", (F.col("mask") + F.when(copy, 1 << 4).otherwise(0)).alias("mask"))
            .agg(F.count(F.lit(1)).alias("n"), F.count_if("is_good").alias("good"),
                 F.count_if("is_toxic").alias("toxic")))


def _folded(orders: Column) -> Column:
    """One cell's 600 structs: for each order a fold over its filters, then all of them in one array."""
    n, good, toxic = F.col("n"), F.col("good"), F.col("toxic")
    none = F.lit(0).cast("long")

    def order_steps(order: Column, number: Column) -> Column:
        def step(acc: Column, k: Column) -> Column:
            fails = F.get(F.col("failed"), F.get(order, k))
            here = acc["there"] & fails
            row = F.struct(
                number.alias("order"), (k + 1).alias("step"), F.get(order, k).alias("filter"),
                F.when(acc["there"] & ~fails, n).otherwise(none).alias("kept"),
                F.when(here, n).otherwise(none).alias("removed"),
                F.when(fails & ~acc["there"], n).otherwise(none).alias("redundant"),
                F.when(fails & (F.aggregate("failed", F.lit(0), lambda c, f: c + f.cast("int")) == 1), n)
                .otherwise(none).alias("unique_fails"),
                F.when(here, good).otherwise(none).alias("good_lost"),
                F.when(here, toxic).otherwise(none).alias("toxic_lost"))
            return F.struct((acc["there"] & ~fails).alias("there"), F.concat(acc["rows"], F.array(row)).alias("rows"))

        start = F.struct(F.lit(True).alias("there"), F.array().cast(_STEPS).alias("rows"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(len(FILTERS) - 1)), start, step, lambda acc: acc["rows"])

    return F.flatten(F.transform(orders, order_steps))


_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
_STEPS = f"array<struct<order:int,step:int,filter:int,{','.join(f'{c}:bigint' for c in _COUNTS)}>>"


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """One row per part, filter order and step: document counts, and the filter's removals over all orders."""
    orders = F.lit(ORDERS)
    failed = F.array(*(F.col("mask").bitwiseAND(1 << k) > 0 for k in range(len(FILTERS))))
    steps = (cells(docs, labels, **columns).withColumn("failed", failed)
             .select("part", F.explode(_folded(orders)).alias("s")).select("part", "s.*"))
    merged = cut(steps.groupBy("part", "order", "step", "filter").agg(*(F.sum(c).alias(c) for c in _COUNTS)))
    shapley = merged.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    letters = F.lit([[FILTERS[k] for k in o] for o in ORDERS])
    return merged.join(shapley, ["part", "filter"]).select(
        "part", F.array_join(F.get(letters, F.col("order")), "").alias("filter_order"),
        "step", *_COUNTS, "shapley")
