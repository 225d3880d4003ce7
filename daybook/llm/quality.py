"""Operator 2: quality rules by a hashed n-gram log-likelihood ratio.

Two multinomials over ``BUCKETS`` hashed byte n-grams: the *raw corpus*, counted
over every n-gram of every document, and the *trusted target*, counted over the
labelled documents of good quality that are not toxic. The score of a document
is the mean of ``log p_target - log p_raw`` over all its n-grams (so it does not
depend on the length), in fixed-point integers, so that it does not depend on
the order of summation either. Every document is held against one threshold,
fitted on the labelled sample (its documents that pass the base rules): the cut with the fewest errors when a lost good
document weighs ``LOST_GOOD`` times a kept bad one; among equal cuts the middle
of the widest gap.

The sample of labels is bounded by ``MAX_LABELLED`` documents, the smallest by a
hash of the id. The counts are merged by a grouped sum; the two tables that reach
the driver have ``BUCKETS`` rows at any input size.

Edge cases: null or empty text has no words and fails the base rules; its score
is null. Without any labelled good document (empty or null labels) there is no
target: scores are null and the base rules alone decide. Several labels of one
document count as the worst of them. Repeated rows and null ids are each scored.
Only id and text are read, other columns can't clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm import textbytes as tb
from daybook.llm.common import id_and_text, rest_type

NGRAM = 4
BUCKETS = 1 << 16
SMOOTHING = 0.5
FIXED_POINT = 1 << 12
MAX_LABELLED = 20_000
LOST_GOOD = 50
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Fixed: the characters counted as symbols.
SYMBOLS = b"#*$%&|<>"

_RAW = tb.byte_table(2, fold_case=False)
_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_CONTINUES = (np.arange(256) & 0xC0) == 0x80


def ngram_buckets(block: tb.Block) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every byte n-gram inside a document, and where each document's n-grams begin (n + 1 ends)."""
    data = block.data.astype(np.uint32)
    m = len(data) - NGRAM + 1
    if m <= 0:
        return np.zeros(0, np.uint16), np.zeros(len(block.start) + 1, np.int64)
    packed = data[:m].copy()
    for k in range(1, NGRAM):
        packed = (packed << np.uint32(8)) | data[k:k + m]
    bucket = ((packed * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)
    inside = np.ones(m, bool)
    ends = np.concatenate([block.end, block.start[1:]])   # also for a null text, whose bytes don't count
    for k in range(1, NGRAM):
        at = ends - k
        inside[at[(at >= 0) & (at < m)]] = False
    gap = block.start[1:] != block.end[:-1]
    for a, b in zip(block.end[:-1][gap], block.start[1:][gap], strict=True):
        inside[a:b] = False
    inside[block.end[-1]:] = False
    kept = np.flatnonzero(inside)
    return bucket[kept], np.searchsorted(kept, np.append(block.start, m))


def base_counts(block: tb.Block) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each document of a block."""
    docs = len(block.start)
    prefix = tb.prefix_hash(block.data, _RAW)
    first, last, doc = tb.words(block)
    word = tb.span_hash(prefix, first, last)

    def per_doc(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
        return total[block.end] - total[block.start]

    in_word = ~tb.SPACES[block.data]
    out = {"n_words": np.bincount(doc, minlength=docs),
           "word_chars": per_doc(in_word & ~_CONTINUES[block.data]),
           "n_symbols": per_doc(_IS_SYMBOL[block.data])}

    # 3-word windows of one document that occur at least twice in it
    repeat = np.zeros(docs, np.int64)
    if len(word) >= 3:
        same = np.flatnonzero(doc[2:] == doc[:-2])
        gram = tb.mix(tb.ngram_hashes(word, 3)[same] + doc[same].astype(np.uint64) * np.uint64(tb.BASE))
        _, inverse, count = np.unique(gram, return_inverse=True, return_counts=True)
        often = same[count[inverse] > 1]
        marked = np.zeros(len(word), bool)
        for k in range(3):
            marked[often + k] = True
        repeat = np.bincount(doc[marked], minlength=docs)
    out["n_repeat_words"] = repeat

    # lines with a word that equal an earlier line of their document
    newline = np.flatnonzero(block.data == 10)
    own = np.searchsorted(block.start, newline, "right") - 1
    newline = newline[newline < block.end[own]] if len(newline) else newline
    begin = np.sort(np.concatenate([block.start, newline + 1]))
    line_doc = np.searchsorted(block.start, begin, "right") - 1
    # a document that is empty shares its first byte with the next one: number its line apart
    order = np.argsort(np.concatenate([block.start * 2, newline * 2 + 3]), kind="stable")
    line_doc = np.concatenate([np.arange(docs), np.searchsorted(block.start, newline, "right") - 1])[order]
    stop = np.append(begin[1:] - 1, block.end[-1:])
    new_doc = np.append(line_doc[1:] != line_doc[:-1], True)
    stop[new_doc] = block.end[line_doc[new_doc]]
    words_before = np.concatenate([[0], np.cumsum(in_word, dtype=np.int64)])
    stop = np.maximum(stop, begin)
    has_word = words_before[stop] > words_before[begin]
    line = tb.mix(tb.span_hash(prefix, begin, stop) + line_doc.astype(np.uint64) * np.uint64(tb.BASE))
    line, line_doc = line[has_word], line_doc[has_word]
    _, where = np.unique(line, return_index=True)
    out["n_dup_lines"] = np.bincount(line_doc, minlength=docs) - np.bincount(line_doc[where], minlength=docs)
    return out


def base_failed(base: dict[str, np.ndarray]) -> np.ndarray:
    return (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEAT_PERCENT * base["n_words"])


def labelled_sample(labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, good): at most ``most`` labelled ids; good is quality 1 and not toxic."""
    one = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("q"),
                        F.col("toxic").cast("int").alias("t")).where(
        "doc_id is not null and q is not null")
    one = one.groupBy("doc_id").agg(F.min("q").alias("q"), F.max(F.coalesce("t", F.lit(0))).alias("t"))
    return (one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
            .select("doc_id", ((F.col("q") == 1) & (F.col("t") == 0)).alias("good")))


def bucket_counts(texts: DataFrame) -> DataFrame:
    """(bucket, raw, target) over (text, good): n-gram counts of all rows and of the good ones."""
    def run(batches):
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            good = np.asarray(batch.column(1).fill_null(False).to_numpy(zero_copy_only=False), bool)
            for block in tb.blocks(batch.column(0)):
                bucket, ends = ngram_buckets(block)
                raw += np.bincount(bucket, minlength=BUCKETS)
                for i in np.flatnonzero(good[block.first:block.first + len(block.start)]):
                    target += np.bincount(bucket[ends[i]:ends[i + 1]], minlength=BUCKETS)
        seen = np.flatnonzero(raw)
        yield pa.record_batch([pa.array(seen.astype(np.int32)), pa.array(raw[seen]), pa.array(target[seen])],
                              names=["bucket", "raw", "target"])
    partial = texts.select("text", "good").mapInArrow(run, "bucket int, raw long, target long")
    return partial.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def ratio_table(counts: DataFrame) -> np.ndarray | None:
    """Fixed-point log ratio of each bucket (``BUCKETS`` entries); None without a target."""
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    got = counts.toPandas()                               # at most BUCKETS rows
    raw[got["bucket"]], target[got["bucket"]] = got["raw"], got["target"]
    if not target.sum():
        return None
    p_target = (target + SMOOTHING) / (target.sum() + SMOOTHING * BUCKETS)
    p_raw = (raw + SMOOTHING) / (raw.sum() + SMOOTHING * BUCKETS)
    return np.rint(np.log(p_target / p_raw) * FIXED_POINT).astype(np.int64)


def ratio_sums(block: tb.Block, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the fixed-point ratios and number of n-grams of each document."""
    bucket, ends = ngram_buckets(block)
    total = np.concatenate([[0], np.cumsum(table[bucket])])
    return total[ends[1:]] - total[ends[:-1]], np.diff(ends)


def fit_threshold(score: np.ndarray, good: np.ndarray) -> float:
    """The cut below which a document is rejected; see the module docstring."""
    order = np.argsort(score, kind="stable")
    score, good = score[order], good[order]
    lost = np.concatenate([[0], np.cumsum(good)]) * LOST_GOOD            # good ones below the cut
    passed = np.concatenate([np.cumsum(~good[::-1])[::-1], [0]])         # bad ones above it
    edge = np.concatenate([[score[0] - 1], score, [score[-1] + 1]])
    gap = np.diff(edge)
    cost = np.where(gap > 0, lost + passed, np.inf)
    best = np.flatnonzero(cost == cost.min())
    k = best[np.argmax(gap[best])]
    return float((edge[k] + edge[k + 1]) / 2)


RESULT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, score double")


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            carry: tuple[str, ...] = ()) -> DataFrame:
    """The base counts, the score and the verdict of every row of ``docs``.

    With ``carry`` also the text and a struct ``rest`` of the named columns.
    """
    spark = docs.sparkSession
    carried = id_and_text(docs, id_col, text_col, carry)
    texts = carried.select("doc_id", "text")
    sample = F.broadcast(labelled_sample(labels))          # at most MAX_LABELLED rows of (long, boolean)
    table = ratio_table(bucket_counts(texts.join(sample, "doc_id", "left")))
    threshold = None
    if table is not None:
        shared = spark.sparkContext.broadcast(table)

        def score(batches):
            for batch in batches:
                for block in tb.blocks(batch.column(0)):
                    total, n = ratio_sums(block, shared.value)
                    judged = ~base_failed(base_counts(block)) & (n > 0)
                    yield pa.record_batch([pa.array(total / np.maximum(n, 1)),
                                           batch.column(1).slice(block.first, len(n))],
                                          names=["s", "good"]).filter(pa.array(judged))
        known = (texts.join(sample, "doc_id").select("text", "good")
                 .mapInArrow(score, "s double, good boolean").toPandas())
        threshold = fit_threshold(known["s"].to_numpy(), known["good"].to_numpy(bool)) if len(known) else None

    def run(batches):
        for batch in batches:
            for block in tb.blocks(batch.column(1)):
                base = base_counts(block)
                failed = base_failed(base)
                kept, none = ~failed, np.ones(len(failed), bool)
                mean = np.zeros(len(failed))
                if threshold is not None:
                    total, n = ratio_sums(block, shared.value)
                    mean, none = total / np.maximum(n, 1), n == 0
                    kept = kept & (mean >= threshold)
                yield pa.record_batch([
                    batch.column(0).slice(block.first, len(failed)),
                    *(pa.array(base[k].astype(np.int64)) for k in RESULT_COUNTS),
                    pa.array(failed), pa.array(kept), pa.array(mean / FIXED_POINT, mask=none),
                    *(batch.column(k).slice(block.first, len(failed)) for k in ((1, 2) if carry else ()))],
                    names=["doc_id", *RESULT_COUNTS, "base_failed", "kept", "score", *(("text", "rest") if carry else ())])
    return carried.mapInArrow(run, RESULT + (f", text string, rest {rest_type(carried)}" if carry else ""))


RESULT_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
