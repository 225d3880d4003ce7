"""Operator 7: benchmark decontamination by spaced seeds.

A document is contaminated by a benchmark item if ``WINDOW`` consecutive words of
both agree in all but at most ``SUBSTITUTIONS`` places. The window is cut into
``SUBSTITUTIONS + 2`` blocks; a mask looks at two of them and ignores the other
positions. Whatever the places of the substitutions, two blocks are free of them,
so one of the fixed masks hits every such window (no loss). Hashes under each
mask are joined between the benchmark's windows and those of every document, and
every hit is verified word by word around it.

The benchmark's distinct windows go to the tasks as sorted hash arrays in parts
of at most ``PART_WINDOWS`` windows (a proven size). A benchmark of one part is looked
up in one pass, without a shuffle. A larger one takes a pass for each part, one after
the other, which writes the hits only; they are joined to the documents at the end.

Words are runs of ASCII letters and digits and of non-ASCII characters, with A-Z
lower-cased. Items of ``MIN_WORDS`` to ``WINDOW - 1`` words match whole and without
substitutions. Shorter items, which any text may hold, match whole as well but are weak
evidence: they are reported apart and contaminate nothing.

Edge cases: null or empty text or item text has no words and matches nothing; null
document ids are kept as they are. An item with a null id contaminates like any other;
it has no id to list, so it is neither listed nor counted. Repeated documents are each returned, repeated items are
each reported (an id once). An empty benchmark contaminates nothing, an empty
table gives an empty result. Other columns of both tables are not read.
"""

from __future__ import annotations

from functools import reduce
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm import textbytes as tb
from daybook.llm.common import cut, id_and_text, rest_type, salted_left_join

WINDOW = 13
SUBSTITUTIONS = 2
MIN_WORDS = 8
PART_WINDOWS = 200_000

#: The complement of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` once A-Z are lower-cased.
SEPARATORS = tb.separators((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
_TABLE = tb.byte_table(3, fold_case=True)


def seed_masks(window: int = WINDOW, substitutions: int = SUBSTITUTIONS) -> list[tuple[int, ...]]:
    """The positions each mask looks at: every pair of the blocks of a window."""
    parts = [p.tolist() for p in np.array_split(np.arange(window), substitutions + 2)]
    return [tuple(a + b) for a, b in combinations(parts, 2)]


MASKS = seed_masks()


def masked_hashes(word: np.ndarray, mask: tuple[int, ...], window: int = WINDOW) -> np.ndarray:
    """Hash of the positions of ``mask`` in the window that starts at each place."""
    m = len(word) - window + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(m, mask[0] + 64 * mask[-1], np.uint64)
    for k in mask:
        out = out * np.uint64(tb.BASE) + word[k:k + m]
    return out ^ (out >> np.uint64(29))


class Windows:
    """A bounded part of the benchmark's windows of one length, indexed by masked hash."""

    def __init__(self, words: np.ndarray, items: list[list[int]], masks: list[tuple[int, ...]], most_wrong: int):
        self.words, self.items, self.masks, self.most_wrong = words, items, masks, most_wrong
        self.length = words.shape[1]
        bits = max(16, int(len(words) * len(masks)).bit_length() + 4)      # at most 2**25 bytes for a part
        self.slot = np.uint64(64 - bits)
        self.filled = np.zeros(1 << bits, bool)
        self.index = []
        for mask in masks:
            key = np.concatenate([masked_hashes(w, mask, self.length) for w in words])
            order = np.argsort(key, kind="stable")
            self.index.append((key[order], order))
            self.filled[self._slots(key)] = True

    def _slots(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> self.slot).astype(np.int64)

    def hits(self, word: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, window) of every verified overlap: the first word in the block, the window's number."""
        found = []
        m = len(word) - self.length + 1
        if m <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        whole = doc[self.length - 1:] == doc[:m]
        for mask, (keys, order) in zip(self.masks, self.index, strict=True):
            key = masked_hashes(word, mask, self.length)
            place = np.flatnonzero(self.filled[self._slots(key)] & whole)
            low = np.searchsorted(keys, key[place], "left")
            n = np.searchsorted(keys, key[place], "right") - low
            place, low, n = place[n > 0], low[n > 0], n[n > 0]
            if not len(place):
                continue
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at, window = np.repeat(place, n), order[np.repeat(low, n) + step]
            wrong = np.zeros(len(at), np.int64)
            for k in range(self.length):
                wrong += word[at + k] != self.words[window, k]
            good = wrong <= self.most_wrong
            found.append(np.stack([at[good], window[good]]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs = np.unique(np.concatenate(found, axis=1), axis=1)
        return pairs[0], pairs[1]


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(n, words, items): the distinct windows of the benchmark as word hashes, with the ids of their items."""
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for block in tb.blocks(batch.column(1)):
                word, doc = tb.word_hashes(block, _TABLE, SEPARATORS)
                at = np.searchsorted(doc, np.arange(len(block.start) + 1))
                out_id, out = [], []
                for i, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
                    n = min(b - a, WINDOW)
                    if not n:
                        continue
                    for p in range(a, b - n + 1):
                        out_id.append(ids[block.first + i].as_py())
                        out.append(word[p:p + n].view(np.int64).tolist())
                yield pa.record_batch([pa.array(out_id, pa.int64()), pa.array(out, pa.list_(pa.int64()))],
                                      names=["item_id", "words"])
    rows = id_and_text(benchmark, id_col, text_col).mapInArrow(run, "item_id long, words array<long>")
    # a null id stands as a null element, behind the others
    unnamed = F.when(F.count_if(F.col("item_id").isNull()) > 0, F.array(F.lit(None).cast("long"))).otherwise(F.array().cast("array<long>"))
    return rows.groupBy("words").agg(F.concat(F.sort_array(F.collect_set("item_id")), unnamed).alias("items"))


def _parts(windows: DataFrame) -> list[list[Windows]]:
    """The benchmark as parts of at most PART_WINDOWS windows, each brought to the driver on its own."""
    n = windows.count()
    parts = -(-n // PART_WINDOWS)
    for part in range(parts):
        mine = windows if parts == 1 else windows.where(F.pmod(F.xxhash64("words"), F.lit(parts)) == part)
        rows = mine.collect()
        by_length: dict[int, list] = {}
        for r in sorted(rows, key=lambda r: r["words"]):
            by_length.setdefault(len(r["words"]), []).append(r)
        out = []
        for length, group in sorted(by_length.items()):
            words = np.array([r["words"] for r in group], np.int64).view(np.uint64)
            exact = length < WINDOW
            out.append(Windows(words, [list(r["items"]) for r in group],
                               [tuple(range(length))] if exact else MASKS, 0 if exact else SUBSTITUTIONS))
        yield out


def _sorted(ids: set) -> list:
    return sorted(x for x in ids if x is not None) + [None] * (None in ids)


def _hits(shared):
    """For a block of texts: the sets of items, of the windows' first words, and of weak items of each text."""
    def hits(block: tb.Block) -> tuple[list[set], list[set], list[set]]:
        word, doc = tb.word_hashes(block, _TABLE, SEPARATORS)
        begin = np.searchsorted(doc, np.arange(len(block.start)))
        items, words, weak = ([set() for _ in block.start] for _ in range(3))
        for index in shared.value:
            strong = index.length >= MIN_WORDS
            for p, w in zip(*(x.tolist() for x in index.hits(word, doc)), strict=True):
                d = int(doc[p])
                (items if strong else weak)[d].update(index.items[w])
                if strong:
                    words[d].add(p - int(begin[d]))
        return items, words, weak
    return hits


_IDS = pa.list_(pa.int64())
_FOUND = "items array<long>, words array<long>, weak array<long>"


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, items, words, weak) of every row: the items that contaminate it (null for one without an id), the
    first word of every window that does (words counted from 0), and the short items that it holds. With
    ``carry`` also the text and a struct ``rest`` of the named columns."""
    spark = docs.sparkSession
    kept = ["text", "rest"] if carry else []
    frame = id_and_text(docs, id_col, text_col, carry)
    carried = f", text string, rest {rest_type(frame)}" if carry else ""
    parts = _parts(cut(benchmark_windows(benchmark, item_col, item_text_col)))
    first, second = next(parts, []), next(parts, None)
    if second is None:
        hits = _hits(spark.sparkContext.broadcast(first))

        def run(batches):
            for batch in batches:
                for block in tb.blocks(batch.column(1)):
                    found = hits(block)
                    own = slice(block.first, block.first + len(block.start))
                    yield pa.record_batch(
                        [batch.column(0)[own], *(pa.array([_sorted(x) for x in f], _IDS) for f in found),
                         *(x[own] for x in batch.columns[1:] if carry)], names=["doc_id", "items", "words", "weak", *kept])
        return frame.mapInArrow(run, f"doc_id long, {_FOUND}{carried}")

    # one pass for each part, written before the next begins: (k1, k2) stands for a text
    keyed = frame.select("text", F.xxhash64("text").alias("k1"), F.hash("text").alias("k2"))
    found = []
    for part in chain([first, second], parts):
        hits = _hits(spark.sparkContext.broadcast(part))

        def run(batches, hits=hits):
            for batch in batches:
                for block in tb.blocks(batch.column(0)):
                    sets = hits(block)
                    at = [i for i in range(len(block.start)) if any(f[i] for f in sets)]
                    rows = pa.array([block.first + i for i in at], pa.int64())
                    yield pa.record_batch([batch.column(1).take(rows), batch.column(2).take(rows),
                                           *(pa.array([_sorted(f[i]) for i in at], _IDS) for f in sets)],
                                          names=["k1", "k2", "items", "words", "weak"])
        found.append(cut(keyed.mapInArrow(run, f"k1 long, k2 int, {_FOUND}").distinct()))
    whole = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    texts = reduce(DataFrame.unionAll, found).groupBy("k1", "k2").agg(whole("items"), whole("words"), whole("weak"))
    none = F.array().cast("array<long>")
    return salted_left_join(frame.withColumns({"k1": F.xxhash64("text"), "k2": F.hash("text")}), texts, ["k1", "k2"]).select(
        "doc_id", *(F.coalesce(c, none).alias(c) for c in ("items", "words", "weak")), *kept)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **columns: str) -> DataFrame:
    """(doc_id, contaminated, kept, n_items, item_ids, n_windows, first_word, weak_item_ids) of every row."""
    found = overlaps(docs, benchmark, **columns)
    named = F.filter("items", lambda x: x.isNotNull())
    return found.select(
        "doc_id", (F.size("items") > 0).alias("contaminated"), (F.size("items") == 0).alias("kept"),
        F.size(named).cast("long").alias("n_items"),
        F.array_join(named.cast("array<string>"), ",").alias("item_ids"),
        F.size("words").cast("long").alias("n_windows"), F.array_min("words").alias("first_word"),
        F.array_join(F.col("weak").cast("array<string>"), ",").alias("weak_item_ids"))
