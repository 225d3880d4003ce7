"""Operator 5: token counts by a map-side two-tier lookup.

The count of a text is the sum of the counts of its pre-tokens. The first tier is
a compact table of the lengths of frequent pre-tokens, broadcast to every task: at
most ``FREQUENT`` words of at most ``bpe.CACHED_WORD_CHARS`` characters, so its
size is bounded at any input. The words a task does not find there are encoded
together by the pair occurrence index and kept in a bounded cache of the Python
worker, the second tier. Pre-tokens are never shuffled on the way to the counts.

The frequent words come from a sample of about ``SAMPLE_DOCS`` whole documents
chosen by a hash of the id, counted by one small grouped sum. The table only
decides which tier answers; every count is exact whatever it holds.

Special strings inside texts count as the library does by default: one token.

Edge cases: null or empty text has no bytes and no tokens and is not over the
limit. Null ids and repeated rows are each counted. An empty table gives an empty
result. Other columns of the input are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm import bpe
from daybook.llm.common import id_and_text

FREQUENT = 32_768
SAMPLE_DOCS = 2_000
TOKEN_LIMIT = 1024

_cache: dict[str, dict[str, int]] = {}


def frequent_words(texts: DataFrame, vocabulary: str, most: int = FREQUENT,
                   sample_docs: int = SAMPLE_DOCS) -> list[str]:
    """At most ``most`` frequent pre-tokens of a sample of whole documents, the most frequent first."""
    step = max(1, texts.count() // sample_docs)
    # drawn by row, not by id or text: ids may be null or equal, and one text a third of all rows
    sample = texts.where(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(step)) == 0)

    def run(batches):
        codec, seen = bpe.codec(vocabulary), Counter()
        for batch in batches:
            for _, part in bpe.texts_in_blocks(batch.column(1)):
                for text in part:
                    seen.update(w for w in codec.pre_tokens(text)
                                if not isinstance(w, int) and len(w) <= bpe.CACHED_WORD_CHARS)
        yield pa.record_batch([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                              names=["word", "n"])
    counted = sample.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [r["word"] for r in counted.orderBy(F.desc("n"), "word").limit(most).collect()]


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = TOKEN_LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row."""
    texts = id_and_text(docs, id_col, text_col)
    words = frequent_words(texts, vocabulary)
    lengths = [len(ids) for ids in bpe.codec(vocabulary).encode_words(words)]
    table = docs.sparkSession.sparkContext.broadcast((words, np.array(lengths, np.uint8)))

    def run(batches):
        codec, misses = bpe.codec(vocabulary), _cache.setdefault(vocabulary, {})
        frequent = dict(zip(table.value[0], table.value[1].tolist(), strict=True))
        for batch in batches:
            for first, part in bpe.texts_in_blocks(batch.column(1)):
                if len(misses) > bpe.CACHE_WORDS:
                    misses.clear()
                pre = [codec.pre_tokens(t) for t in part]
                new = [w for w in set().union(*pre)
                       if w not in frequent and w not in misses and not isinstance(w, int)]
                here = {w: len(ids) for w, ids in zip(new, codec.encode_words(new), strict=True)}
                misses.update((w, n) for w, n in here.items() if len(w) <= bpe.CACHED_WORD_CHARS)
                found = []
                for tokens in pre:
                    n = 0
                    for w in tokens:
                        k = frequent.get(w)
                        if k is None:
                            k = misses.get(w) or here.get(w) or 1      # a special token is one
                        n += k
                    found.append(n)
                n_bytes = [len(t.encode("utf-8")) for t in part]
                yield pa.record_batch([
                    batch.column(0).slice(first, len(part)), pa.array(n_bytes, pa.int64()),
                    pa.array(found, pa.int64()), pa.array([n > limit for n in found], pa.bool_())],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return texts.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
