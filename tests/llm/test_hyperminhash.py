import random

import numpy as np
import pyarrow as pa
import pytest
from helpers_llm import FOLD, WORDS, edge_rows, frame, prose, stage_tasks, table, texts_of

from pyspark.sql import functions as F

from daybook.llm import hyperminhash as op
from daybook.llm import textbytes as tb
from daybook.llm.common import components, sieved


def shingles(text):
    w = WORDS.findall((text or "").translate(FOLD))
    if len(w) >= 5:
        return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    return frozenset([tuple(w)] if w else [])


def brute_force(rows):
    """(doc_id, n_shingles, component_id, kept) of every row, by all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, s in sets:
        for b, t in sets:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i), i is None or find(i) == i) for i, s in sets), key=repr)


def result(docs):
    return sorted((tuple(r) for r in op.near_duplicates(docs).collect()), key=repr)


def chains(start):
    rng, rows, i = random.Random(3), [], start
    for _ in range(4):
        words = prose(rng, 90).split(" ")
        for _ in range(14):           # each copy changes the one before, so only a chain links the ends
            rows.append((i, " ".join(words)))
            i += 1
            words[rng.randrange(90)] = f"w{i}"
            words[rng.randrange(90)] = f"v{i}"
    return rows


def test_smallest_table_edge_rows_and_chains_match_brute_force(spark):
    """The table's documents, the edge rows and chains of copies under ids of their own, in one run."""
    rows = [(i + 1000, t) for i, t in texts_of(table(spark, "documents"))] + edge_rows() + chains(5000)
    assert result(frame(spark, rows)) == brute_force(rows)


def around_a_passage(n, seed=9):
    """Documents that share half of their shingles with all others and are alike in nothing else, and a few near copies."""
    rng = random.Random(seed)
    passage = prose(rng, 60)
    rows = [(k, f"{passage} {prose(rng, 55)}") for k in range(n)]
    for k in range(0, n, 10):
        words = rows[k][1].split(" ")
        words[70 + k % 40] = f"w{k}"
        rows.append((n + k, " ".join(words)))
    return rows


@pytest.mark.parametrize("splits", [0, 1, 3])
def test_mixed_buckets_are_split_and_lose_no_link(spark, monkeypatch, splits):
    monkeypatch.setattr(op, "BLOCK", 20)
    monkeypatch.setattr(op, "SPLITS", splits)
    rows = around_a_passage(160)
    assert result(frame(spark, rows)) == brute_force(rows)


def registers_of(text):
    return next(op.registers(h) for h, _ in op.shingle_sets(next(tb.blocks(pa.array([text])))))


def test_a_link_that_shares_one_large_bucket_alone_is_kept(spark, monkeypatch):
    """Two documents at the threshold agree in one band of 32, whose bucket mixes more than BLOCK members."""
    monkeypatch.setattr(op, "BLOCK", 20)
    rng = random.Random(3714)

    def words(n):
        return " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    common = words(52)
    a, b = f"{common} {words(8)}", f"{common} {words(8)}"
    bands = [registers_of(t).reshape(op.BANDS, op.ROWS_PER_BAND) for t in (a, b)]
    shared = np.flatnonzero((bands[0] == bands[1]).all(axis=1))
    assert len(shared) == 1 and 100 * len(shingles(a) & shingles(b)) == 75 * len(shingles(a) | shingles(b))
    passage, around = words(20), []
    while len(around) < 40:                  # alike among each other, so that one of them is the bucket's hub
        text = f"{common} {passage} {words(20)}"
        if (registers_of(text).reshape(op.BANDS, -1)[shared] == bands[0][shared]).all():
            around.append(text)
    rows = [*enumerate(around), (100, a), (101, b)]
    got = result(frame(spark, rows))
    assert got == brute_force(rows) and (101, 56, 100, False) in got


@pytest.mark.parametrize("block", [1, 3, 1024])
def test_pairs_by_rare_shingles_hold_every_link(spark, monkeypatch, block):
    """Dealt to blocks or not, all pairs at the threshold with two labels are there; two texts of one id both count."""
    monkeypatch.setattr(op, "BLOCK", block)
    rows = chains(0) + around_a_passage(40, 5)[:44]
    rows = [(k, t) for k, (_, t) in enumerate(rows)] + [(3, rows[-1][1]), (3, rows[-1][1]), (4, "few words"), (999, None)]
    members = spark.createDataFrame([(k, k // 2) for k in range(len(rows) - 4)], "node long, label long")
    found = op.alike_by_rare_shingles(members, frame(spark, rows), 75, 5)
    got = [(r.a, r.b) for r in found.collect()]
    sets = [(i, shingles(t)) for i, t in rows if i < len(rows) - 4]
    links = {(a, b) for a, s in sets for b, t in sets if a < b and a // 2 != b // 2 and 100 * len(s & t) >= 75 * len(s | t) > 0}
    assert links <= set(got) and len(links) > 20 and len(got) == len(set(got)) and all(a < b and a // 2 != b // 2 for a, b in got)


def test_a_passage_in_all_members_makes_no_pairs_of_them(spark):
    """3,000 documents whose sets are half a common passage: no pair of them is looked at, only the near copies."""
    rng = random.Random(4)
    passage = " ".join(f"p{k}" for k in range(64))
    rows = [(k, f"{passage} " + " ".join(f"w{rng.randrange(10**9)}" for _ in range(60))) for k in range(3000)]
    rows += [(5000, rows[7][1] + " end"), (5001, rows[8][1] + " end")]
    members = spark.createDataFrame([(k, k) for k, _ in rows], "node long, label long")
    got = {(r.a, r.b) for r in op.alike_by_rare_shingles(members, frame(spark, rows), 75, 5).collect()}
    assert got == {(7, 5000), (8, 5001)}


def test_a_mixed_bucket_of_many_members_stays_linear(spark, monkeypatch):
    """50,000 members of one bucket, in as many components: what is compared follows the members, not their square."""
    n, rng = 50_000, np.random.default_rng(3)
    sketch = rng.integers(0, 1 << 14, (n, op.REGISTERS)).astype(np.uint16)
    common = rng.random((n, op.REGISTERS)) < 0.3            # a passage that gives each register with this probability
    sketch[common] = np.broadcast_to(np.arange(op.REGISTERS, dtype=np.uint16), sketch.shape)[common]
    sketch[:, :op.ROWS_PER_BAND] = 7                        # all of them share the first band
    sketch[1::1000, 4:] = sketch[::1000, 4:]                # near copies
    fine = rng.integers(1, 255, (n, op.FINE)).astype(np.uint8)
    fine[1::1000] = fine[::1000]
    key = int(sketch[0, :4].copy().view(np.int64)[0])
    import pandas as pd
    nodes = spark.createDataFrame(pd.DataFrame({"node": np.arange(n), "registers": [r.tobytes() for r in sketch],
                                                "fine": [f.tobytes() for f in fine]})).repartition(8)
    rest = nodes.select(F.lit(0).alias("band"), F.lit(key).cast("long").alias("key"), "node", F.lit(1).alias("weight"), F.col("node").alias("label"))
    dealt, whole = [], op.cut
    monkeypatch.setattr(op, "cut", lambda df: dealt.append(whole(df)) or dealt[-1])
    got = {(r.a, r.b) for r in op.across_components(rest, nodes, 0.75).distinct().collect()}
    assert got == {(k, k + 1) for k in range(0, n, 1000)}
    rows = [d.agg(F.sum(F.col("blocks").cast("long"))).first()[0] or 0 for d in dealt if "blocks" in d.columns]
    assert rows[0] == n * -(-n // op.BLOCK)                 # this deal is not made ...
    assert sum(d.where("blocks = 1").count() for d in dealt[1:]) < 31 * n and len(dealt) == 2    # ... but split into small groups


def test_empty_table(spark):
    assert result(frame(spark, [])) == []


def test_registers_are_an_unbiased_estimate():
    rng = np.random.default_rng(1)
    for size in (30, 300, 5000):
        shared = rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2)
        a = np.unique(np.concatenate([shared, rng.integers(0, 1 << 63, size // 6, dtype=np.uint64)]))
        b = np.unique(np.concatenate([shared, rng.integers(0, 1 << 63, size // 6, dtype=np.uint64)]))
        truth = size / (size + 2 * (size // 6))
        assert op.jaccard_estimate((op.registers(a) == op.registers(b)).mean()) == pytest.approx(truth, abs=0.16)


def test_sets_do_not_depend_on_the_block():
    texts = pa.array([t for _, t in edge_rows()])
    whole = [s.tolist() for b in tb.blocks(texts) for s, _ in op.shingle_sets(b)]
    alone = [s.tolist() for b in tb.blocks(texts, 1) for s, _ in op.shingle_sets(b)]
    assert whole == alone


def test_components_of_random_graphs(spark):
    """A sparse random graph, a path and a loop, with ids of their own, in one edge list."""
    rng = random.Random(11)
    edges = [(rng.randrange(40), rng.randrange(40)) for _ in range(30)]
    edges += [(100 + k, 101 + k) for k in range(25)] + [(200, 200)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


@pytest.mark.parametrize("few", [0, 20_000])
def test_components_of_a_small_graph_take_one_partition(spark, monkeypatch, few):
    """The same labels with exchanges and without; a small graph stays in one partition."""
    from daybook.llm import common
    monkeypatch.setattr(common, "FEW", few)
    edges = [(k, k + 1) for k in range(0, 30) if k % 10 != 9] + [(5, 5), (7, 2), (None, 3)]
    merging = "spark.sql.adaptive.coalescePartitions.enabled"      # else Spark joins small partitions afterwards
    spark.conf.set(merging, False)
    try:
        found = components(spark.createDataFrame(edges, "a long, b long"))
        assert {r["node"]: r["label"] for r in found.collect()} == {k: k // 10 * 10 for k in range(30)}
        assert (found.rdd.getNumPartitions() == 1) == bool(few)
    finally:
        spark.conf.unset(merging)


def test_small_tables_do_not_take_a_task_for_each_shuffle_partition(spark):
    """Steps on what a checkpoint wrote take as many tasks as its rows are worth, and members that fit one are broadcast."""
    rng = random.Random(3)
    base = [prose(rng, 60).split(" ") for _ in range(12)]
    rows = [(100 * k + n, " ".join(w[:30] + [f"x{n}"] + w[31:])) for k, w in enumerate(base) for n in range(4)]
    out = []
    took = stage_tasks(spark, lambda: out.extend(op.near_duplicates(frame(spark, rows)).collect()))
    assert {r.doc_id: r.component_id for r in out} == {i: i // 100 * 100 for i, _ in rows}
    assert 0 < sum(n >= 64 for n in took) <= 40


@pytest.mark.parametrize("per_task", [1500, 1_000_000])
def test_a_sieve_keeps_every_row_with_one_of_the_ids_and_few_others(spark, monkeypatch, per_task):
    from daybook.llm import common
    monkeypatch.setattr(common, "ROWS", 100)
    monkeypatch.setattr(common, "SIEVE_TASK", per_task)
    ids = spark.range(4000).select((F.col("id") * 5 - 900).alias("node"))
    rows = spark.range(20_000).select((F.col("id") - 1000).alias("doc_id"), F.lit("x").alias("text"))
    rows = rows.union(rows.where("doc_id = 0")).union(spark.createDataFrame([(None, None)], "doc_id long, text string"))
    kept = [r.doc_id for r in sieved(rows, "doc_id", ids, "node", 4000).collect()]
    wanted = {r.node for r in ids.collect()} & set(range(-1000, 19_000))
    assert wanted <= set(kept) and kept.count(0) == 2 and len(kept) == len(set(kept)) + 1
    assert len(kept) - len(wanted) < 0.06 * 20_000
    assert sieved(rows, "doc_id", ids.limit(0), "node", 0).isEmpty()


def test_texts_are_not_shuffled_to_find_the_members(spark, monkeypatch):
    """Whatever the number of members: of tables with texts only those of pairs to verify are dealt out."""
    from daybook.llm import common
    monkeypatch.setattr(common, "ROWS", 1)
    plans, whole = [], op.cut

    def watched(df):
        if "text" in df.columns:
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return whole(df)
    monkeypatch.setattr(op, "cut", watched)
    rows = chains(0)
    assert result(frame(spark, rows)) == brute_force(rows)
    assert len(plans) == 2 and not any("LeftSemi" in p for p in plans[:1]) and all("rightHint=(strategy=broadcast)" in p for p in plans)
