"""Operator 1: near-duplicate documents by HyperMinHash.

Every document is the set of its distinct word shingles. One 64-bit hash per
shingle picks one of ``REGISTERS`` buckets with its top bits; of the smallest
remaining hash of a bucket only the number of leading zeros and the next
``MANTISSA`` bits are stored, 16 bits a register. Buckets without a shingle
borrow a filled one, chosen by a fixed hash sequence of the bucket number
(optimal densification), so that the chance of equal registers stays the
Jaccard similarity for short documents too.

* Banding: the compressed registers themselves, four at a time, are the band
  keys (64 bits). Documents that share a key are candidates.
* Estimate: the share of equal registers, less the share expected to collide by
  chance, drops candidates far below the threshold.
* Verification: what is left is compared on the full shingle sets.

Copies with the same words are one *class*, represented by its smallest id, so
that groups of copies of any size cost one node. In a bucket of classes no pair
list is made. Each bucket compares all its members with one hub, the member with
the most bucket neighbours; what the hub confirms is one component. Then
``STAR_ROUNDS`` further rounds compare the rest of each bucket with a hub of theirs. The
members of all buckets that still hold different components, of any size, are joined
exactly on their full shingle sets: two sets at the threshold share one of the rarest
shingles of each (``alike_by_rare_shingles``). A common passage is not rare, so the work
follows the members and not their square, and no cap or sketch drops a pair.

Edge cases: null or empty text, or one without words, has an empty set and is
linked with nothing. Fewer words than a shingle: the whole sequence is the one
shingle. Rows with a null id are returned, never linked (``component_id`` null,
``kept`` true). Repeated rows are each returned; the rows of one id share its
links. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm import textbytes as tb
from daybook.llm.common import cut, id_and_text, merged_labels, salted_join, sieved, tasks

SHINGLE_WORDS = 5
THRESHOLD_PERCENT = 75
REGISTERS = 128
REGISTER_BITS = 7                    # log2(REGISTERS)
MANTISSA = 10                        # mantissa bits kept beside the leading-zero count
ROWS_PER_BAND = 4
BANDS = REGISTERS // ROWS_PER_BAND
ESTIMATE_SLACK = 0.20                # over five standard deviations of the estimate at the threshold
STAR_ROUNDS = 1
BLOCK = 1024                         # members of a group compared at a time
FINE = 1024                          # registers of the sharper sketch of ``fine_sketches``
SPLITS = 3                           # times ``across_components`` splits a larger bucket by further bands

_TABLE = tb.byte_table(1, fold_case=True)


def shingle_sets(block: tb.Block, size: int = SHINGLE_WORDS) -> Iterator[tuple[np.ndarray, int]]:
    """For each document of a block: its sorted distinct shingle hashes, and a hash of its word sequence."""
    word, doc = tb.word_hashes(block, _TABLE)
    grams = tb.ngram_hashes(word, size)
    cut_at = np.searchsorted(doc, np.arange(len(block.start) + 1))
    prefix = np.zeros(len(word) + 1, np.uint64)
    np.cumsum(word * tb.powers(len(word))[0], out=prefix[1:])
    sequences = (prefix[cut_at[1:]] - prefix[cut_at[:-1]]) * tb.powers(len(word) + 1)[1][cut_at[:-1]]
    for a, b in zip(cut_at[:-1].tolist(), cut_at[1:].tolist(), strict=True):
        if a == b:
            yield np.zeros(0, np.uint64), 0
            continue
        sequence = int(sequences[doc[a]])
        if b - a < size:
            # the whole sequence as one shingle, distinct from any shingle of the full size
            yield tb.mix(np.array([sequence ^ (b - a)], np.uint64)), sequence
        else:
            yield np.unique(grams[a:b - size + 1]), sequence


def _borrow_order() -> np.ndarray:
    """For every register the fixed sequence of registers from which it borrows while empty."""
    rng = np.random.default_rng(20240131)
    return np.stack([rng.permutation(REGISTERS) for _ in range(REGISTERS)])


_BORROW = _borrow_order()


def registers(hashes: np.ndarray) -> np.ndarray:
    """The densified HyperMinHash registers (uint16) of one non-empty set of hashes."""
    bucket = (hashes >> np.uint64(64 - REGISTER_BITS)).astype(np.int64)
    # the hashes are sorted, so the first of every bucket is its smallest
    filled, first = np.unique(bucket, return_index=True)
    rest = hashes[first] << np.uint64(REGISTER_BITS)
    top = rest >> np.uint64(11)                              # 53 bits: exact as a float
    exponent = np.frexp(top.astype(np.float64))[1]           # 0 for a zero value
    zeros = np.minimum(53 - exponent, 63).astype(np.uint64)
    shifted = rest << np.minimum(zeros + np.uint64(1), np.uint64(63))
    value = (zeros << np.uint64(MANTISSA)) | (shifted >> np.uint64(64 - MANTISSA))
    out = np.zeros(REGISTERS, np.uint16)
    out[filled] = value.astype(np.uint16)
    if len(filled) < REGISTERS:
        has = np.zeros(REGISTERS, bool)
        has[filled] = True
        empty = np.flatnonzero(~has)
        order = _BORROW[empty]
        out[empty] = out[order[np.arange(len(empty)), has[order].argmax(axis=1)]]
    return out


def chance_collision() -> float:
    """Probability that two unrelated registers are equal: the leading zeros follow a
    geometric law of ratio one half, the mantissa is uniform (collision correction)."""
    return sum(4.0 ** -(z + 1) for z in range(50)) / (1 << MANTISSA)


def jaccard_estimate(equal_share: float) -> float:
    """Collision-corrected similarity from the share of equal registers."""
    c = chance_collision()
    return (equal_share - c) / (1 - c)


SIGNATURE = "doc_id long, n_shingles long, class_a long, class_b long, registers binary"


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, n_shingles, class_a, class_b, registers) of every row; equal word sequences share a class."""
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for block in tb.blocks(batch.column(1)):
                n, a, b, r = [], [], [], []
                for hashes, sequence in shingle_sets(block, shingle):
                    n.append(len(hashes))
                    a.append(np.int64(np.uint64(sequence)))
                    b.append(np.int64(np.bitwise_xor.reduce(hashes)) if len(hashes) else np.int64(0))
                    r.append(registers(hashes).tobytes() if len(hashes) else None)
                yield pa.record_batch([
                    ids.slice(block.first, len(n)), pa.array(n, pa.int64()), pa.array(a, pa.int64()),
                    pa.array(b, pa.int64()), pa.array(r, pa.binary())], names=SIGNATURE_NAMES)
    return id_and_text(docs, id_col, text_col).mapInArrow(run, SIGNATURE)


SIGNATURE_NAMES = [x.split()[0] for x in SIGNATURE.split(", ")]


def band_rows(nodes: DataFrame) -> DataFrame:
    """(band, key, node): each node under the 64-bit key of each of its bands."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            regs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16)
            keys = regs.reshape(batch.num_rows, BANDS, ROWS_PER_BAND).copy().view(np.int64).ravel()
            yield pa.record_batch([
                pa.array(np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows)), pa.array(keys),
                pa.array(np.repeat(np.asarray(batch.column(0)), BANDS))], names=["band", "key", "node"])
    return nodes.select("doc_id", "registers").mapInArrow(run, "band int, key long, node long")


def estimated(pairs: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """The candidate pairs whose collision-corrected estimate is at least ``least``."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16)
                           .reshape(batch.num_rows, REGISTERS) for k in (2, 3))
            c = chance_collision()
            good = ((left == right).mean(axis=1) - c) / (1 - c) >= least
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good))
    left = sketches.select(F.col("doc_id").alias("a"), F.col("registers").alias("ra"))
    right = sketches.select(F.col("doc_id").alias("b"), F.col("registers").alias("rb"))
    # a hub has many pairs; its registers are small enough to repeat for a few salts
    return (salted_join(pairs, left, ["a"], "b").join(right, "b").select("a", "b", "ra", "rb")
            .mapInArrow(run, "a long, b long"))


def verified(pairs: DataFrame, texts: DataFrame, percent: int, shingle: int) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold."""
    def run(batches):
        last_id, last_set = None, None
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            sets = []
            left, right = batch.column(2), batch.column(3)
            good = []
            for block in tb.blocks(right):
                sets.extend(s for s, _ in shingle_sets(block, shingle))
            for i, other in enumerate(sets):
                text = left[i]
                if a[i] != last_id or last_set[0] != text:
                    block = next(tb.blocks(pa.array([text.as_py()], pa.string())))
                    last_id, last_set = a[i], (text, next(shingle_sets(block, shingle))[0])
                mine = last_set[1]
                both = len(np.intersect1d(mine, other, assume_unique=True))
                good.append(both > 0 and 100 * both >= percent * (len(mine) + len(other) - both))
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                  names=["a", "b"]).filter(pa.array(good, pa.bool_()))
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
    # whole texts aren't repeated for salts; where a hub's pairs skew the join, AQE splits them
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
            .mapInArrow(run, "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = THRESHOLD_PERCENT, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``."""
    texts = id_and_text(docs, id_col, text_col)
    sig = cut(signatures(docs, id_col, text_col, shingle))
    linkable = sig.where("doc_id is not null and n_shingles > 0")
    classes = cut(linkable.groupBy("class_a", "class_b").agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows")))
    classes = classes.coalesce(tasks(classes.count()))

    def sketched(sets: DataFrame) -> DataFrame:
        return (classes.join(sets, (classes["rep"] == sets["doc_id"]) & (classes["class_a"] == sets["class_a"])
                             & (classes["class_b"] == sets["class_b"])).select("doc_id", "registers"))

    # buckets with at least two members; the others can link nothing
    rows = band_rows(sketched(linkable))
    full = (rows.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("node").alias("least"))
            .where("n > 1"))
    buckets = cut(salted_join(rows, full, ["band", "key"], "node").select("band", "key", "node", "n"))
    places = tasks(buckets.count())                  # partitions of what has a row for each place of a member in a bucket
    buckets = buckets.coalesce(places)
    members = cut(buckets.groupBy("node").agg(F.sum("n").alias("weight")))
    n_members = members.count()
    nodes = tasks(n_members)                         # partitions of what has a row for each member
    members = members.coalesce(nodes)

    def known(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if nodes == 1 else df
    # the few others that pass the sieve are in no pair
    sketches = cut(sketched(sieved(linkable, "doc_id", members, "node", n_members))).coalesce(nodes)
    texts_in = cut(sieved(texts, "doc_id", members, "node", n_members))
    least = percent / 100 - ESTIMATE_SLACK

    def confirmed(pairs: DataFrame) -> DataFrame:
        return cut(verified(estimated(pairs, sketches, least), texts_in, percent, shingle))

    # the hub of a bucket: its member with the most bucket neighbours overall, then the smallest id
    weighted = cut(buckets.join(known(members), "node").select("band", "key", "node", "weight")).coalesce(places)
    hub = weighted.groupBy("band", "key").agg(
        F.max(F.struct("weight", (-F.col("node")).alias("minus"))).alias("h"))
    hub = hub.select("band", "key", (-F.col("h.minus")).alias("hub"))
    stars = (salted_join(weighted, hub, ["band", "key"], "node").where("node <> hub")
             .select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct())
    label = merged_labels(members.select("node", F.col("node").alias("label")), confirmed(stars), nodes)
    for _ in range(STAR_ROUNDS):
        # once more, around the heaviest member outside the bucket's largest component
        rest = _rest(weighted, known(label)).coalesce(places)
        hub = (rest.where("not main").groupBy("band", "key")
               .agg(F.max(F.struct("weight", (-F.col("node")).alias("minus"), "label")).alias("h"))
               .select("band", "key", (-F.col("h.minus")).alias("hub"), F.col("h.label").alias("hub_label")))
        pairs = (salted_join(rest, hub, ["band", "key"], "node").where("label <> hub_label")
                 .select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct())
        label = merged_labels(label, confirmed(pairs.join(stars, ["a", "b"], "left_anti")), nodes)
    mixed = cut(_rest(weighted, known(label)).coalesce(places).select("node", "label").distinct()).coalesce(nodes)
    leftover = cut(alike_by_rare_shingles(known(mixed), texts_in, percent, shingle))
    label = merged_labels(label, cut(verified(leftover, texts_in, percent, shingle)), nodes)

    # classes that share a representative id (rows of one id with two texts) are linked as well; the only row of a
    # class that is its own component needs no join
    by_class = (classes.join(known(label), classes["rep"] == label["node"], "left")
                .where("rows > 1 or label <> rep")
                .select("class_a", "class_b", F.coalesce("label", "rep").alias("component_id")))
    plain = sig.select("doc_id", "n_shingles", "class_a", "class_b")
    salted = plain.withColumn("s", F.when(F.col("n_shingles") > 0, F.pmod(F.xxhash64("doc_id"), F.lit(32)).cast("int")))
    spread = by_class.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(31))))
    out = salted.join(spread, ["class_a", "class_b", "s"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def fine_sketches(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, fine): ``FINE`` one-byte registers, not densified, 0 for an empty bucket."""
    def run(batches):
        for batch in batches:
            for block in tb.blocks(batch.column(1)):
                out = []
                for hashes, _ in shingle_sets(block, shingle):
                    hashes = np.sort(tb.mix(hashes))
                    bucket, first = np.unique((hashes % np.uint64(FINE)).astype(np.int64), return_index=True)
                    row = np.zeros(FINE, np.uint8)
                    row[bucket] = 1 + (hashes[first] >> np.uint64(20)) % np.uint64(255)
                    out.append(row.tobytes())
                yield pa.record_batch([batch.column(0).slice(block.first, len(out)), pa.array(out, pa.binary())],
                                      names=["node", "fine"])
    return texts.select("doc_id", "text").mapInArrow(run, "node long, fine binary")


def shingle_rows(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, copy, size, gram): every shingle of every text; ``copy`` hashes the words, as rows of one id may differ."""
    names = ["node", "copy", "size", "gram"]

    def run(batches):
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for block in tb.blocks(batch.column(1)):
                for k, (hashes, sequence) in enumerate(shingle_sets(block, shingle)):
                    n = len(hashes)
                    yield pa.record_batch([
                        pa.array(np.full(n, ids[block.first + k], np.int64)),
                        pa.array(np.full(n, np.uint64(sequence).astype(np.int64))),
                        pa.array(np.full(n, n, np.int64)), pa.array(hashes.view(np.int64))], names=names)
    return texts.select("doc_id", "text").mapInArrow(run, "node long, copy long, size long, gram long")


def alike_by_rare_shingles(members: DataFrame, texts: DataFrame, percent: int, shingle: int) -> DataFrame:
    """Pairs (a, b) of members (node, label) with two labels, with all that reach the threshold among them.

    All sets are put in one order, rare shingles first. Sets of n and m shingles at the
    threshold have percent * (n + m) / (100 + percent) in common, which is at least
    ``percent`` of either. So their first common shingle has a place in the first part of each
    set, and behind that place both still hold as many shingles as must be common; the
    smaller set, its *lead*, has it in a shorter part yet. Pairs that meet this in a common
    shingle are returned. The members of a large group, those with one shingle in that
    part, are dealt to blocks, and its leads to blocks of their own: each pair of
    blocks is compared as arrays.
    """
    # the few others that pass the sieve only count in the order of the shingles
    mine = cut(sieved(texts, "doc_id", members, "node", members.count()).select("doc_id", "text"))
    grams = shingle_rows(mine, shingle)
    common = grams.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")   # others are first, and nobody's common one
    own = Window.partitionBy("node", "copy")
    place = F.col("size") - F.count("*").over(own) + F.row_number().over(own.orderBy("n", "gram")) - 1
    held = salted_join(grams, common, ["gram"], "node").select("node", "size", "gram", place.alias("place"))
    held = held.where(100 * F.col("place") <= (100 - percent) * F.col("size")).withColumn(
        "lead", (100 + percent) * (F.col("size") - F.col("place")) >= 2 * percent * F.col("size"))
    held = cut(held.join(members, "node"))
    groups = held.groupBy("gram").agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.ceil(F.count_if("lead") / BLOCK).cast("int").alias("of_leads"),
        F.min("label").alias("low"), F.max("label").alias("high"))
    groups = groups.where("low <> high and of_leads > 0").drop("low", "high")
    block, of_leads = (F.pmod(F.xxhash64("node"), F.col(k)).cast("int") for k in ("blocks", "of_leads"))
    to_leads = F.transform(F.sequence(F.lit(0), F.col("of_leads") - 1), lambda i: F.struct(
        i.alias("i"), block.alias("j"), F.lit(False).alias("leads")))
    as_lead = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(
        of_leads.alias("i"), j.alias("j"), F.lit(True).alias("leads")))
    dealt = salted_join(held, groups, ["gram"], "node").select(
        "gram", "node", "label", "size", "place", "lead",
        F.explode(F.when(F.col("lead"), F.concat(to_leads, as_lead)).otherwise(to_leads)).alias("at"))

    def compare(table: pa.Table) -> pa.Table:
        node, label, size, place, lead, leads = (
            np.asarray(table.column(k)) for k in ("node", "label", "size", "place", "lead", "leads"))
        behind = (100 + percent) * (size - place)
        left, right = np.flatnonzero(leads), np.flatnonzero(~leads)
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for x in left:
            ok = (label[right] != label[x]) & (np.minimum(behind[right], behind[x]) >= percent * (size[right] + size[x]))
            found = node[right[ok & ~(lead[right] & (node[right] < node[x]))]]   # of two leads each looks at the larger id
            a.append(np.minimum(found, node[x]))
            b.append(np.maximum(found, node[x]))
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})
    return (dealt.select("gram", "node", "label", "size", "place", "lead", "at.*").groupBy("gram", "i", "j")
            .applyInArrow(compare, "a long, b long").distinct())


def across_components(rest: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """Pairs of one bucket but two components that both sketches leave near the threshold.

    An estimate for callers that keep sketches and no texts; a pair that shares one large
    bucket alone is not among them. ``near_duplicates`` doesn't use it, it has the exact
    ``alike_by_rare_shingles``.

    A bucket of up to ``BLOCK`` members is one group. A larger one is split ``SPLITS`` times at
    most: its members meet again where another band agrees too. What is larger
    even then, members that agree in ``SPLITS + 1`` bands and yet are in several components, is
    dealt to blocks by a hash, and each pair of blocks is one group. Groups are
    compared as arrays. A pair that shares several buckets is looked at in the first of
    its bands alone, or in each of its split ones.
    """
    bands = band_rows(sketches.select(F.col("node").alias("doc_id"), "registers")).select(
        F.struct(F.col("band"), F.col("key")).alias("more"), "node")
    group = F.struct(F.col("band"), F.col("key"))
    rows = rest.select(F.array(group).alias("path"), "node", "label")
    ready = []
    for level in range(SPLITS + 1):
        size = rows.groupBy("path").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
        size = size.where("low <> high").select("path", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
        sized = cut(salted_join(rows, size, ["path"], "node"))
        ready.append(sized if level == SPLITS else sized.where("blocks = 1"))
        large = sized.where("blocks > 1")
        if level == SPLITS or large.isEmpty():
            break
        # a path is a set of bands, so the groups reached by several orders of them are one
        rows = (large.join(bands, "node").where(~F.exists("path", lambda p: p["band"] == F.col("more.band")))
                .select(F.array_sort(F.concat("path", F.array("more"))).alias("path"), "node", "label").distinct())
    dealt = reduce(DataFrame.unionAll, ready).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.withColumn("other", other).select(
        "path", F.when(F.size("path") == 1, F.col("path")[0]["band"]).otherwise(0).alias("band"),
        F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "node", "label")
    dealt = dealt.join(sketches, "node")         # last, so that only the deal itself moves the sketches
    c = chance_collision()
    slack = 4 * (threshold * (1 - threshold) / FINE) ** 0.5

    def compare(table: pa.Table) -> pa.Table:
        band, i, j = (table.column(k)[0].as_py() for k in ("band", "i", "j"))
        mine, node, label = (np.asarray(table.column(k)) for k in ("mine", "node", "label"))
        regs = np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
        fine = np.frombuffer(b"".join(table.column("fine").to_pylist()), np.uint8).reshape(-1, FINE)
        left, right = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
        right_regs, right_node, right_label = regs[right], node[right], label[right]
        a, b = [], []
        for x in left:
            ok = right_label != label[x]
            if i == j:
                ok &= right_node > node[x]
            at = np.flatnonzero(ok)
            if not len(at):
                continue
            equal = right_regs[at] == regs[x]
            at = at[(equal.mean(axis=1) - c) / (1 - c) >= threshold - ESTIMATE_SLACK]
            if len(at) and band:
                earlier = (right_regs[at, :band * ROWS_PER_BAND] == regs[x, :band * ROWS_PER_BAND])
                at = at[~earlier.reshape(len(at), band, ROWS_PER_BAND).all(axis=2).any(axis=1)]
            if len(at):
                other_fine, own = fine[right[at]], fine[x]
                union = ((other_fine > 0) | (own > 0)).sum(axis=1)
                same = ((other_fine == own) & (own > 0)).sum(axis=1)
                at = at[same >= (threshold - slack) * union]
            a.extend([node[x]] * len(at))
            b.extend(right_node[at])
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})
    return dealt.groupBy("path", "i", "j").applyInArrow(compare, "a long, b long")


def _rest(weighted: DataFrame, label: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component, with their labels.

    ``main``: the member is of the component of the bucket's first hub, the heaviest member.
    """
    marked = weighted.join(label, "node")
    mixed = (marked.groupBy("band", "key")
             .agg(F.min("label").alias("low"), F.max("label").alias("high"),
                  F.max(F.struct("weight", (-F.col("node")).alias("minus"), "label")).alias("h"))
             .where("low <> high").select("band", "key", F.col("h.label").alias("main_label")))
    return cut(salted_join(marked, mixed, ["band", "key"], "node").select(
        "band", "key", "node", "weight", "label", (F.col("label") == F.col("main_label")).alias("main")))
