import math

import numpy as np
import pytest
from helpers_llm import table

from daybook.llm import projections as op

SCHEMA = "vec_id long, embedding array<float>, label int, node long, unit string, h1 int"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, g, 1, "clash", 2) for i, v, g in rows], schema)


def ok(i, v, g):
    return i is not None and g is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute_force(rows):
    """(vec_id, n_links, component_id, kept) of every row, by all pairs of distinct rows."""
    live = list({(i, tuple(np.float32(v).tolist()), g): None for i, v, g in rows if ok(i, v, g)})
    parent, links = list(range(len(live))), np.zeros(len(live), int)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for group in {(g, len(v)) for _, v, g in live}:
        at = [k for k, (_, v, g) in enumerate(live) if (g, len(v)) == group]
        x = np.array([live[k][1] for k in at], np.float64)
        norm = np.linalg.norm(x, axis=1)
        near = (x @ x.T) / norm[:, None] / norm >= 0.93
        np.fill_diagonal(near, False)
        for a, b in zip(*np.nonzero(near), strict=True):
            links[at[a]] += 1
            p, q = find(at[a]), find(at[b])
            parent[max(p, q)] = min(p, q)
    least = {}
    for k, (i, *_) in enumerate(live):
        least[find(k)] = min(i, least.get(find(k), i))
    place = {key: k for k, key in enumerate(live)}
    out = []
    for i, v, g in rows:
        k = place[i, tuple(np.float32(v).tolist()), g] if ok(i, v, g) else None
        c = i if k is None else least[find(k)]
        out.append((i, 0 if k is None else int(links[k]), c, i is None or c == i))
    return sorted(out, key=repr)


def result(docs, **how):
    return sorted((tuple(r) for r in op.near_vectors(docs, **how).collect()), key=repr)


def spread(rng, n, dim=32):
    x = rng.standard_normal((n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def around(rng, centre, n, cosine):
    """n unit vectors at one cosine from a centre."""
    y = rng.standard_normal((n, len(centre)))
    y -= np.outer(y @ centre, centre)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    return cosine * centre + math.sqrt(1 - cosine * cosine) * y


def clumps(seed=4, n=900):
    """Random vectors, and clumps of several widths, in two labels."""
    rng, rows = np.random.default_rng(seed), []
    parts = [spread(rng, n)] + [around(rng, c, k, cos) for c, k, cos in
                                zip(spread(rng, 6), (400, 60, 60, 30, 2, 3), (0.995, 0.97, 0.96, 0.99, 0.99, 0.95), strict=True)]
    for k, v in enumerate(np.concatenate(parts)):
        rows.append((int(rng.integers(1 << 40)), np.float32(v * rng.uniform(.5, 3)).tolist(), int(k % 7 == 0)))
    return rows


def test_groups_of_one_cell_match_brute_force(spark):
    rows = clumps()
    assert result(frame(spark, rows), cell_rows=5000) == brute_force(rows)


@pytest.mark.parametrize(("cell_rows", "crowded"), [(100, 1), (60, 1000), (60, 2)])
def test_cells_balls_and_blocks(spark, cell_rows, crowded):
    """Small cells: routing loses few links and adds none; crowded cells give balls, or blocks where those are off."""
    rows = clumps()
    got = {r[0]: r for r in result(frame(spark, rows), cell_rows=cell_rows, crowded=crowded)}
    want = {r[0]: r for r in brute_force(rows)}
    assert got.keys() == want.keys()
    assert all(got[i][1] <= want[i][1] for i in got)
    assert sum(r[1] for r in got.values()) >= 0.99 * sum(r[1] for r in want.values())
    same = sum(got[i][2:] == want[i][2:] for i in got)
    assert same >= 0.99 * len(want)


def test_recall_of_pairs_at_the_threshold(spark):
    """Pairs just above the threshold among many others, routed to small cells: at least 0.95 are found."""
    rng = np.random.default_rng(8)
    a = spread(rng, 1500, 64)
    b = np.stack([around(rng, v, 1, 0.931)[0] for v in a[:300]])
    rows = [(k, np.float32(v).tolist(), 1) for k, v in enumerate(np.concatenate([a, b]))]
    got = result(frame(spark, rows), cell_rows=128)
    want = brute_force(rows)
    assert sum(r[1] for r in got) >= 0.95 * sum(r[1] for r in want) >= 0.95 * 600


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    v, w = [1.0, 2.0, 3.0], [2.0, 4.0, 6.0]
    rows = [(1, v, 1), (2, v, 1), (2, v, 1), (3, w, 1), (4, v, 2), (5, v, None), (6, None, 1), (7, [], 1), (8, [0.0, 0.0, 0.0], 1),
            (9, [1.0, nan, 3.0], 1), (10, [1.0, inf, 3.0], 1), (11, [1.0, None, 3.0], 1), (None, v, 1), (None, None, None),
            (12, [1.0, 2.0, 3.0, 0.0], 1), (13, [-1.0, -2.0, -3.0], 1), (14, [-0.0, 1e-40, 0.0], 3), (15, [0.0, 1e-38, 0.0], 3),
            (16, [3e38, 3e38, 3e38], 4), (17, [1.0, 1.0, 1.0], 4), (1, [5.0, -2.0, 0.0], 1), (18, v, 1)]
    assert result(frame(spark, rows)) == brute_force(rows)


def test_a_third_of_the_rows_are_copies(spark):
    rng = np.random.default_rng(2)
    x = spread(rng, 200, 8)
    rows = [(k, np.float32(x[0] if k % 3 == 0 else x[k % 200]).tolist(), 1) for k in range(1500)]
    assert result(frame(spark, rows)) == brute_force(rows)


def test_smallest_table_and_empty_table(spark):
    vectors = table(spark, "embeddings")
    rows = [tuple(r) for r in vectors.select("vec_id", "embedding", "label").collect()]
    assert result(vectors) == brute_force(rows)
    assert result(frame(spark, [])) == []


def test_collisions_needed_follow_the_binomial():
    p, need = math.erf(op.SPREAD / math.sqrt(2)), op.least_collisions()
    reach = [sum(math.comb(op.PROJECTIONS, k) * p ** k * (1 - p) ** (op.PROJECTIONS - k)
                 for k in range(c, op.PROJECTIONS + 1)) for c in (need, need + 1)]
    assert reach[0] >= op.RECALL > reach[1]


def test_routing_cost_grows_slower_than_the_square():
    angle = math.acos(op.THRESHOLD)
    work = [n * t * n / 2 ** k for n in (10 ** 5, 10 ** 7) for k, t in [op.routing(n, 1.0, angle, op.CELL_ROWS)]]
    assert work[1] < 100 ** 1.3 * work[0]
