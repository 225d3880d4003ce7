"""Operator 10: removal of repeated byte strings by merged Burrows-Wheeler transforms.

Each byte covered by a string of ``LENGTH`` bytes that starts at two or more places
of the corpus (other documents, the same one, overlapping) is removed; strings never
cross documents and are judged on the input.

1. *Routing.* Every window of ``LENGTH`` bytes is named by its minimizer, the smallest
   hash of the ``GRAM``-byte grams in it; equal windows have equal minimizers. A
   grouped count finds the minimizers that stand at two places or more; neighbouring
   windows of one such minimizer are a *run*, a string of a few hundred bytes. All
   other text is done, unsorted.
2. *Copies.* Equal runs are counted; where a run stands twice, all its windows are
   repeated. One of each kind of run goes on, so copies of any number cost one.
3. *Shard transforms.* The distinct runs are dealt by minimizer. A task reads their
   bytes as strings over an alphabet of ``BLOCK``-byte blocks (one string for every
   phase), cuts them into shards and builds each shard's Burrows-Wheeler transform.
4. *Merge.* The transforms are merged by refining their interleave: starting from the
   trivial interleave, each iteration deals the merged transform to its symbols in
   order, which sorts by one more block without comparing suffixes again. A boundary
   that appears in iteration d separates neighbours with d - 1 blocks in common; what
   is not separated after ``LENGTH / BLOCK`` iterations is a repeated interval.

Runs of a very frequent minimizer with many different surroundings (over
``WIDE_CLASS`` of them, or over ``WIDE_BYTES`` bytes) are cut to pieces of ``PIECE`` windows, named by all bytes that
the windows of a piece share, and counted again. Where more than ``WIDE_ROUTE`` distinct
pieces have one name (many documents go on differently behind one passage), their
windows are counted one by one, by the hash of a whole window. So no task solves more
than a bounded number of strings, whatever the size of a class.

Edge cases: null or empty text counts as empty; shorter texts than ``LENGTH`` lose
nothing. Null ids and repeated rows are documents of their own, repeated rows lose
all that is in a whole window. An empty table gives an empty result. A very long text
is scanned in overlapping slices. Only id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm import textbytes as tb
from daybook.llm.common import cut, id_and_text, salted_join

LENGTH = 400
GRAM = 128
BLOCK = 100
DEPTH = LENGTH // BLOCK
SLICE = 1 << 20
SHARD_BYTES = 1 << 18
BATCH_BYTES = 1 << 21
WIDE_CLASS = 2_000
WIDE_BYTES = 1 << 22
WIDE_ROUTE = 2_000
PIECES_AT_ONCE = 4_096
PIECE = 16
KEY_SALTS = 4                # tables of minimizers and runs, many rows
TEXT_SALTS = 8               # spans of texts, joined to whole texts

_TABLE = tb.byte_table(4, fold_case=False)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_SPAN = LENGTH - GRAM + 1            # grams in a window


def _sliding(values: np.ndarray, size: int, pick: np.ufunc, fill: np.uint64) -> np.ndarray:
    """``pick`` over every ``size`` consecutive values (len - size + 1 of them), in linear time."""
    n = len(values)
    padded = np.full(-(-n // size) * size, fill, np.uint64)
    padded[:n] = values
    table = padded.reshape(-1, size)
    forward = pick.accumulate(table, axis=1).ravel()
    backward = pick.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(backward[:n - size + 1], forward[size - 1:n])


def _slices(block: tb.Block):
    """(first byte in the block, data, document starts and ends): parts of a block that share no window."""
    n = len(block.data)
    for at in range(0, max(n, 1), SLICE):
        stop = min(n, at + SLICE + LENGTH - 1)
        start, end = np.clip(block.start, at, stop) - at, np.clip(block.end, at, stop) - at
        yield at, block.data[at:stop], start, end
        if stop == n:
            return


def _minimizers(data: np.ndarray, start: np.ndarray, end: np.ndarray):
    """(windows inside a document, their minimizers, the hash of every gram, prefix hash)."""
    prefix = tb.prefix_hash(data, _TABLE)
    n = len(data)
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), prefix
    at = np.arange(n - GRAM + 1)
    gram = tb.span_hash(prefix, at, at + GRAM)
    least = _sliding(gram, _SPAN, np.minimum, _NONE)
    step = np.zeros(n + 1, np.int64)
    whole = end - start >= LENGTH
    np.add.at(step, start[whole], 1)
    np.add.at(step, end[whole] - LENGTH + 1, -1)
    inside = np.flatnonzero(np.cumsum(step[:n - LENGTH + 1]) > 0)
    return inside, least, gram, prefix


def anchor_counts(texts: DataFrame) -> DataFrame:
    """(m, n): the minimizers that stand at two places or more."""
    def run(batches):
        for batch in batches:
            for block in tb.blocks(batch.column(0)):
                for _, data, start, end in _slices(block):
                    inside, least, gram, _ = _minimizers(data, start, end)
                    if not len(inside):
                        continue
                    own = np.zeros(len(least), np.uint64)
                    own[inside] = least[inside]
                    # a gram is an anchor if it is the largest minimizer of the windows around it
                    pad = np.zeros(_SPAN - 1, np.uint64)
                    around = _sliding(np.concatenate([pad, own, pad]), _SPAN, np.maximum, np.uint64(0))
                    value, n = np.unique(gram[gram == around[:len(gram)]], return_counts=True)
                    yield pa.record_batch([pa.array(value.view(np.int64)), pa.array(n.astype(np.int64))],
                                          names=["m", "n"])
    counted = texts.select("text").mapInArrow(run, "m long, n long")
    return counted.groupBy("m").agg(F.sum("n").alias("n")).where("n > 1").select("m")


RUN = "m long, c long, k1 long, k2 int, start long, windows int"


def runs(texts: DataFrame) -> DataFrame:
    """(m, c, k1, k2, start, windows): every run of windows of one minimizer; ``c`` hashes its bytes."""
    names = [x.split()[0] for x in RUN.split(", ")]

    def run(batches):
        for batch in batches:
            k1, k2 = (np.asarray(batch.column(k)) for k in (1, 2))
            for block in tb.blocks(batch.column(0)):
                for shift, data, start, end in _slices(block):
                    inside, least, _, prefix = _minimizers(data, start, end)
                    if not len(inside):
                        continue
                    m = least[inside]
                    new = np.ones(len(inside), bool)
                    new[1:] = (np.diff(inside) != 1) | (m[1:] != m[:-1])
                    first = np.flatnonzero(new)
                    windows = np.diff(np.append(first, len(inside)))
                    at = inside[first]
                    content = tb.span_hash(prefix, at, at + windows - 1 + LENGTH) + windows.astype(np.uint64)
                    doc = np.searchsorted(block.start, at + shift, "right") - 1
                    yield pa.record_batch([
                        pa.array(m[first].view(np.int64)), pa.array(content.view(np.int64)),
                        pa.array(k1[block.first + doc]), pa.array(k2[block.first + doc]),
                        pa.array(at + shift - block.start[doc]), pa.array(windows.astype(np.int32))], names=names)
    return texts.select("text", "k1", "k2").mapInArrow(run, RUN)


class Shard:
    """The Burrows-Wheeler transform, to DEPTH symbols, of some strings.

    ``entry`` lists the suffixes in order; ``symbol[entry - BLOCK]`` precedes each.
    """

    def __init__(self, symbol: np.ndarray, first: np.ndarray):
        n = len(symbol)
        rank, width = symbol.astype(np.int64), BLOCK
        while width < LENGTH:                           # prefix doubling within the shard
            after = np.zeros(n, np.int64)
            after[:n - width] = rank[width:]
            after[rank == 0] = 0
            _, rank_new = np.unique(rank * (rank.max() + 1) + after, return_inverse=True)
            rank = np.where(symbol == 0, 0, rank_new + 1)
            width *= 2
        self.entry = np.argsort(rank, kind="stable")
        before = np.zeros(n, symbol.dtype)
        before[BLOCK:] = symbol[:-BLOCK]
        before[first] = 0                               # the first suffix of a string follows its end mark
        self.transform = before[self.entry]


def merged_classes(shards: list[Shard]) -> list[np.ndarray]:
    """For each shard, the class of its suffixes in its order: equal exactly for equal first DEPTH symbols.

    The interleave of the shards is refined DEPTH times; suffixes are not compared.
    """
    sizes = [len(s.entry) for s in shards]
    transforms = np.concatenate([s.transform for s in shards])
    interleave = np.repeat(np.arange(len(shards), dtype=np.uint16), sizes)
    group = np.zeros(len(interleave), np.int64)
    for _ in range(DEPTH):
        merged = np.empty_like(transforms)
        merged[np.argsort(interleave, kind="stable")] = transforms
        order = np.argsort(merged, kind="stable")
        symbol, before = merged[order], group[order]
        interleave = interleave[order]
        new = np.zeros(len(order), bool)
        new[1:] = (symbol[1:] != symbol[:-1]) | ((before[1:] != before[:-1]) & (symbol[1:] != 0))
        group = np.cumsum(new)
    own = group[np.argsort(interleave, kind="stable")]
    return np.split(own, np.cumsum(sizes)[:-1])


def repeated_windows(contents: list[bytes]) -> list[np.ndarray]:
    """For each string whether each of its windows of LENGTH bytes stands at two places of the strings."""
    data = np.frombuffer(b"".join(contents), np.uint8)
    size = np.array([len(c) for c in contents])
    begin = np.cumsum(size) - size
    prefix = tb.prefix_hash(data, _TABLE)
    # entry p of a string: the block that starts there, or its end mark (0) in the last BLOCK places
    string = np.repeat(np.arange(len(contents)), size + 1)
    place = np.arange(len(string)) - np.repeat(np.cumsum(size + 1) - size - 1, size + 1)
    real = place <= np.repeat(size, size + 1) - BLOCK
    at = begin[string[real]] + place[real]
    symbol = np.zeros(len(string), np.int32)
    symbol[real] = np.unique(tb.span_hash(prefix, at, at + BLOCK), return_inverse=True)[1] + 1
    edge = np.cumsum(size + 1)
    shards, cuts, low = [], [], 0
    for k in range(len(contents)):
        if edge[k] - low >= SHARD_BYTES or k == len(contents) - 1:
            here = slice(low, edge[k])
            shards.append(Shard(symbol[here], np.flatnonzero(place[here] < BLOCK)))
            cuts.append(low)
            low = edge[k]
    classes = merged_classes(shards)
    count = np.bincount(np.concatenate(classes))
    twice = np.zeros(len(string), bool)
    for low, shard, own in zip(cuts, shards, classes, strict=True):
        twice[low + shard.entry] = count[own] > 1
    return [twice[e - n - 1:e - LENGTH] for e, n in zip(edge, size, strict=True)]


def _intervals(flags: np.ndarray) -> list[dict]:
    step = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return [{"a": int(a), "b": int(b)} for a, b in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1), strict=True)]


SPANS = "array<struct<a:int,b:int>>"


def compared(contents: DataFrame) -> DataFrame:
    """(m, c, shift, spans): the repeated windows of the distinct runs, found class by class of ``route``."""
    parts = int(contents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (contents.select("route", "m", "c", "shift", "content").repartition(parts, "route")
             .sortWithinPartitions("route", "m", "c", "shift"))

    def solve(rows):
        found = repeated_windows([r[4] for r in rows])
        out = [(r[1], r[2], r[3], _intervals(f)) for r, f in zip(rows, found, strict=True) if f.any()]
        return pa.record_batch([
            pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
            pa.array([r[2] for r in out], pa.int32()),
            pa.array([r[3] for r in out], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))],
            names=["m", "c", "shift", "spans"])

    def run(batches):
        rows, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if rows and row[0] != last and size >= BATCH_BYTES:
                    yield solve(rows)
                    rows, size = [], 0
                if rows and row[:4] == rows[-1][:4]:
                    continue                            # the same run from a repeated row
                rows.append(row)
                size += len(row[4])
                last = row[0]
        if rows:
            yield solve(rows)
    return dealt.mapInArrow(run, f"m long, c long, shift int, spans {SPANS}")


def fetched(needed: DataFrame, texts: DataFrame) -> DataFrame:
    """(m, c, wide, content): the bytes of one place of each needed run."""
    per_text = needed.groupBy("k1", "k2", "rep").agg(
        F.collect_list(F.struct("m", "c", "wide", "start", "windows")).alias("runs"))
    joined = texts.join(per_text, (texts["k1"] == per_text["k1"]) & (texts["k2"] == per_text["k2"])
                        & texts["doc_id"].eqNullSafe(per_text["rep"])).select("text", "runs")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 32):
                part = batch.slice(at, 32)
                out = []
                for text, wanted in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    raw = text.encode("utf-8")
                    out += [(r["m"], r["c"], r["wide"], raw[r["start"]:r["start"] + r["windows"] - 1 + LENGTH])
                            for r in wanted]
                yield pa.record_batch([pa.array([r[k] for r in out], t) for k, t in enumerate(
                    (pa.int64(), pa.int64(), pa.bool_(), pa.binary()))], names=["m", "c", "wide", "content"])
    return joined.mapInArrow(run, "m long, c long, wide boolean, content binary")


def pieces(contents: DataFrame) -> DataFrame:
    """(route, m, c, shift, content, piece): runs of wide classes in pieces, named by what their windows share.

    The offset of a window's first minimizer is a property of its bytes; windows of
    one offset group share all bytes from the first one's end side to the last one's
    begin, and ``route`` hashes those.
    """
    def run(batches):
        for batch in batches:
            for m, c, content in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                data = np.frombuffer(content, np.uint8)
                prefix = tb.prefix_hash(data, _TABLE)
                at = np.arange(len(data) - GRAM + 1)
                spots = at[tb.span_hash(prefix, at, at + GRAM).view(np.int64) == m]
                window = np.arange(len(data) - LENGTH + 1)
                offset = spots[np.searchsorted(spots, window)] - window
                new = np.ones(len(window), bool)
                new[1:] = (offset[1:] // PIECE != offset[:-1] // PIECE) | (np.diff(offset) != -1)
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(window)) - 1
                anchor = first + offset[first]
                low = anchor - offset[first] // PIECE * PIECE                  # the begin all windows of the group reach
                route = tb.span_hash(prefix, low, low - PIECE + 1 + LENGTH) + (offset[first] // PIECE).astype(np.uint64)
                whole = tb.span_hash(prefix, first, last + LENGTH) + (last - first).astype(np.uint64)
                for k in range(0, len(first), PIECES_AT_ONCE):
                    some = slice(k, k + PIECES_AT_ONCE)
                    n = len(first[some])
                    yield pa.record_batch([
                        pa.array(route[some].view(np.int64)), pa.array([m] * n, pa.int64()),
                        pa.array([c] * n, pa.int64()), pa.array(first[some].astype(np.int32)),
                        pa.array([content[a:b + LENGTH] for a, b in zip(first[some], last[some], strict=True)], pa.binary()),
                        pa.array(whole[some].view(np.int64))], names=["route", "m", "c", "shift", "content", "piece"])
    return contents.select("m", "c", "content").mapInArrow(
        run, "route long, m long, c long, shift int, content binary, piece long")


def single_windows(contents: DataFrame) -> DataFrame:
    """(w, m, c, shift, at): the hash and the place of every window of every piece."""
    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                raw = part.column(3).to_pylist()
                size = np.array([len(x) for x in raw])
                windows = size - LENGTH + 1
                row = np.repeat(np.arange(len(raw)), windows)
                at = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
                first = (np.cumsum(size) - size)[row] + at
                prefix = tb.prefix_hash(np.frombuffer(b"".join(raw), np.uint8), _TABLE)
                w = tb.span_hash(prefix, first, first + LENGTH)
                yield pa.record_batch([pa.array(w.view(np.int64)), *(part.column(k).take(pa.array(row)) for k in range(3)),
                                       pa.array(at.astype(np.int32))], names=["w", "m", "c", "shift", "at"])
    return contents.select("m", "c", "shift", "content").mapInArrow(run, "w long, m long, c long, shift int, at int")


def counted(contents: DataFrame) -> DataFrame:
    """(m, c, shift, spans): as ``compared``, by a grouped count of single windows; for routes of any size."""
    windows = cut(single_windows(contents))
    repeated = windows.groupBy("w").agg(F.count("*").alias("n")).where("n > 1").select("w")
    found = salted_join(windows, repeated, ["w"], "c")
    return found.groupBy("m", "c", "shift").agg(F.array_sort(F.collect_set(F.struct(
        F.col("at").alias("a"), (F.col("at") + 1).cast("int").alias("b")))).alias("spans"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(k1, k2, spans): the repeated byte ranges of every text that has any; ``docs`` has doc_id, text, k1, k2."""
    texts = docs.where(F.octet_length("text") >= LENGTH)
    recurring = anchor_counts(texts).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(KEY_SALTS - 1))))
    found = runs(texts).withColumn("salt", F.pmod(F.col("k1"), F.lit(KEY_SALTS)).cast("int"))
    places = cut(found.join(recurring, ["m", "salt"]).groupBy("m", "c", "k1", "k2", "start", "windows")
                 .agg(F.count("*").alias("n")))
    reps = texts.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
    kinds = places.groupBy("m", "c").agg(
        F.sum("n").alias("n"), F.min(F.struct("k1", "k2", "start", "windows")).alias("p"))
    kinds = cut(kinds.select("m", "c", "n", "p.*"))
    classes = (kinds.groupBy("m").agg(F.count("*").alias("kinds"), F.min("n").alias("fewest"),
                                      F.sum(F.col("windows").cast("long") + LENGTH - 1).alias("bytes"))
               .where("fewest = 1").select("m", ((F.col("kinds") > WIDE_CLASS) | (F.col("bytes") > WIDE_BYTES)).alias("wide")))
    needed = salted_join(kinds, classes, ["m"], "c").join(reps, ["k1", "k2"]).select(
        "m", "c", "wide", "k1", "k2", "rep", "start", "windows")
    contents = cut(fetched(needed, texts))

    narrow = contents.where("not wide").select(F.col("m").alias("route"), "m", "c", F.lit(0).alias("shift"), "content")
    results = compared(narrow)
    wide = contents.where("wide")
    if not wide.isEmpty():
        results = results.union(_wide_results(wide))
    once = kinds.where("n = 1").select("m", "c").join(results, ["m", "c"]).select("m", "c", "shift", "spans")
    often = kinds.where("n > 1").select("m", "c", F.lit(0).alias("shift"), F.array(
        F.struct(F.lit(0).alias("a"), F.col("windows").alias("b"))).alias("spans"))
    known = cut(once.union(often)).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(KEY_SALTS - 1))))
    salted = places.withColumn("salt", F.pmod(F.col("k1"), F.lit(KEY_SALTS)).cast("int"))
    absolute = F.transform("spans", lambda s: F.struct(
        (F.col("start") + F.col("shift") + s["a"]).alias("a"),
        (F.col("start") + F.col("shift") + s["b"] - 1 + LENGTH).alias("b")))
    return (salted.join(known, ["m", "c", "salt"]).select("k1", "k2", absolute.alias("spans"))
            .groupBy("k1", "k2").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans")))


def _wide_results(wide: DataFrame) -> DataFrame:
    """The spans of runs of wide classes, piece by piece."""
    cutup = cut(pieces(wide))
    same = cutup.groupBy("route", "piece").agg(F.count("*").alias("n"), F.min(F.struct("m", "c", "shift")).alias("p"))
    same = cut(same.select("route", "piece", "n", "p.*"))
    shared = same.groupBy("route").agg(F.count("*").alias("pieces")).where("pieces > 1")
    chosen = salted_join(same, shared, ["route"], "c").select("route", "m", "c", "shift", "pieces")
    chosen = cut(cutup.drop("piece").join(chosen, ["route", "m", "c", "shift"]))
    solved = compared(chosen.where(F.col("pieces") <= WIDE_ROUTE))
    large = chosen.where(F.col("pieces") > WIDE_ROUTE)
    if not large.isEmpty():
        solved = solved.union(counted(large))
    # what holds for the chosen piece holds for every equal one; equal pieces are repeated whole
    of_piece = same.join(solved, ["m", "c", "shift"]).select("route", "piece", "spans")
    whole = cutup.join(same.where("n > 1").select("route", "piece"), ["route", "piece"]).select(
        "m", "c", "shift", F.array(F.struct(F.lit(0).alias("a"), (
            F.octet_length("content") - LENGTH + 1).cast("int").alias("b"))).alias("spans"))
    partly = (cutup.select("route", "piece", "m", "c", "shift")
              .join(of_piece.join(same.where("n = 1").select("route", "piece"), ["route", "piece"]), ["route", "piece"])
              .select("m", "c", "shift", "spans"))
    return whole.union(partly)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row; ``kept`` are the remaining bytes."""
    texts = id_and_text(docs, id_col, text_col).select(
        "doc_id", "text", F.xxhash64("text").alias("k1"), F.hash("text").alias("k2"))
    spans = repeated_spans(texts).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(TEXT_SALTS - 1))))
    salted = texts.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(TEXT_SALTS)).cast("int"))
    joined = salted.join(spans, ["k1", "k2", "salt"], "left").select("doc_id", "text", "spans")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                rows = []
                for text, found in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    raw = (text or "").encode("utf-8")
                    kept, done, spans_here, removed = [], 0, 0, 0
                    for s in found or []:
                        if s["a"] > done or not spans_here:
                            kept.append(raw[done:s["a"]])
                            spans_here += 1
                            removed += s["b"] - s["a"]
                            done = s["b"]
                        elif s["b"] > done:
                            removed += s["b"] - done
                            done = s["b"]
                    kept.append(raw[done:])
                    rows.append((len(raw), removed, spans_here, b"".join(kept)))
                yield pa.record_batch([part.column(0), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(
                    (pa.int64(), pa.int64(), pa.int64(), pa.binary())))], names=OUT_NAMES)
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


OUT_NAMES = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
