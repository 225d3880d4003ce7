import math

import numpy as np
import pytest
from helpers_llm import table
from pyspark.sql import functions as F

from daybook.llm import covertree as op
from daybook.llm import queries

SCHEMA = "vec_id long, embedding array<double>, label int, shard int, anchor long, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, g, 1, 2, "clash") for i, v, g in rows], SCHEMA)


def brute_force(rows, is_anchor, k=5, n=10):
    live = list({(i, tuple(v), g): None for i, v, g in rows if i is not None and g is not None and v is not None
                 and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for i, v, g in live:
        if not is_anchor(i):
            continue
        scored = [(-sum(int(p) * int(q) for p, q in zip(v, w, strict=True)), j, h) for j, w, h in live if len(w) == len(v)]
        for p, j, _ in sorted(s for s in scored if s[2] == g and s[1] != i)[:k]:
            far = sorted(s for s in scored if s[2] != g and 30 * -p <= 100 * -s[0] <= 90 * -p)[:n]
            out.extend((i, j, r, m, -p, -s) for r, (s, m, _) in enumerate(far, 1))
    return sorted(out)


def result(docs, every=5, **how):
    return sorted(tuple(r) for r in op.hard_negatives(docs, F.col("vec_id") % every == 0, **how).collect())


def vectors(seed, n, dim=6, clumps=12, labels=4, size=40):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-size, size, (clumps, dim))
    x = centres[rng.integers(0, clumps, n)] + rng.integers(-3, 4, (n, dim))
    return [(int(i), v.tolist(), int(g)) for i, v, g in zip(rng.permutation(n), x.astype(float), rng.integers(0, labels, n), strict=True)]


@pytest.mark.parametrize("how", [{}, {"tree_rows": 50, "trees_each": 2, "anchors_each": 20}])
def test_clumped_vectors_match_brute_force(spark, how):
    """Many equal scores; one tree, and many trees, cells and blocks of anchors."""
    rows = vectors(1, 700)
    assert result(frame(spark, rows), **how) == brute_force(rows, lambda i: i % 5 == 0)


def test_query_on_the_smallest_table(spark):
    rows = [(r[0], [float(math.floor(256 * x)) for x in r[1]], (r[2] + 1) % 10 if r[0] % 7 == 0 else r[2])
            for r in table(spark, "embeddings").select("vec_id", "embedding", "label").collect()]
    got = sorted(tuple(r) for r in queries.op13_hard_negatives(spark, "/root/testdata/sf0.001").collect())
    assert got == brute_force(rows, lambda i: i % 100 == 0) != []


def test_query_scales_whole_and_broken_components(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 0.25], 1), (1, [0.5, 0.2], 1), (2, [0.3, 0.2], 2), (3, [nan, 1.0], 2), (4, [inf, 1.0], 2), (5, [None, 1.0], 2),
            (6, None, 2), (8, [0.3, 0.2], None), (None, [0.3, 0.2], 2), (7, [0.3, -0.0001], 9), (9, [-0.3, -0.2], 2)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    scaled = [(i, None if v is None else [x if x is None or not math.isfinite(x) else float(math.floor(256 * float(np.float32(x))))
                                          for x in v], g) for i, v, g in rows]
    scaled = [(i, v, (g + 1) % 10 if i is not None and i % 7 == 0 else g) for i, v, g in scaled]
    got = sorted(tuple(r) for r in queries.op13_hard_negatives(spark, str(tmp_path)).collect())
    assert got == brute_force(scaled, lambda i: i % 100 == 0) != []


def test_edge_rows(spark):
    """Repeated rows, one id with several vectors, other lengths, empty vectors, zero and negative scores, scores over 2**53."""
    big = 2.0 ** 30
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (1, [2.0, 2.0], 1), (1, [2.0, 2.0], 1), (1, [1.0, 1.0], 1), (2, [1.0, 1.0], 2),
            (2, [1.0, 1.0], 2), (3, [1.0, 1.0], 3), (4, [], 1), (5, [], 1), (6, [], 2), (7, [1.0], 1), (10, [-5.0, -1.0], 4),
            (11, [5.0, 1.0], 4), (12, [big, 1.0, big - 1], 1), (15, [big, big, 3.0], 1), (16, [big, 1.0, 5.0], 2), (17, [big, 1.0, 4.0], 2),
            (18, [big, 1.0, 4.0], 2), (15, [0.0, 0.0, 0.0], 5), (19, [0.0, 0.0, 0.0], 5), (20, [0.0, 0.0, 0.0], 6)]
    assert result(frame(spark, rows), every=5) == brute_force(rows, lambda i: i % 5 == 0)
    assert result(frame(spark, rows), every=1) == brute_force(rows, lambda i: True)


def test_hot_label_and_few_rows(spark):
    rows = [(k, [float(k % 13), float(k % 7 - 3), 1.0], 1 if k % 3 else k % 50) for k in range(600)]
    assert result(frame(spark, rows), every=30, tree_rows=64) == brute_force(rows, lambda i: i % 30 == 0)
    assert result(frame(spark, rows[:1]), every=1) == []
    assert result(frame(spark, [])) == []


def test_positive_scores_beyond_a_long_count_as_the_nearest_long(spark):
    far = 2.0 ** 40
    rows = [(0, [far], 1), (1, [far], 1), (2, [far / 2], 2), (3, [1.0], 2), (4, [2.0 ** 22], 3)]
    assert result(frame(spark, rows)) == [(0, 1, 1, 4, op.LONG, 1 << 62)]


def test_descent_skips_what_its_bounds_exclude():
    """On clumped vectors a descent scores a small part of the rows, and finds what a full pass finds."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-400, 400, (60, 8))
    x = (centres[rng.integers(0, 60, 2000)] + rng.integers(-2, 3, (2000, 8))).astype(float)
    label = rng.integers(0, 3, 2000)
    built = op.build(x, label)
    assert sorted(built["order"]) == list(range(2000))
    import pyarrow as pa
    source = pa.table({"dim": [8] * 2000, "shard": [0] * 2000, "vec_id": range(2000), "label": [str(g) for g in label],
                       "vector": x.tolist()})
    row = op._index(source)
    tree = op.Tree({c: row.column(c)[0] for c in row.column_names})
    scored = []
    tree.scores = lambda rows, a, length, f=tree.scores: scored.append(len(rows)) or f(rows, a, length)
    for k in range(40):
        a = x[k * 50]
        top = int((x @ a)[label == label[k * 50]].max())
        windows = [(-(-3 * top // 10), 9 * top // 10), (-(-2 * top // 10), 5 * top // 10)]
        got = op.descend([tree], a, str(label[k * 50]), -1, windows, 10, same=False)
        all_rows = sorted((-int(s), i) for i, s in enumerate(x @ a) if label[i] != label[k * 50])
        for (low, high), found in zip(windows, got, strict=True):
            assert found == [(-s, i) for s, i in all_rows if low <= -s <= high][:10]
    assert sum(scored) < 0.25 * 40 * 2000
