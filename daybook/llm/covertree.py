"""Operator 13: hard-negative mining with cover trees.

The score of a row for an anchor is their inner product. Rows are dealt into
shards of about ``TREE_ROWS`` and each shard is indexed whole by a cover tree. For
its metric every vector gets one more component that brings all of a shard to
the same norm; then a node with centre ``c`` and covering radius ``r`` (of its level,
the largest distance of a row below it) bounds every inner product with an
anchor ``a`` below it by ``<a, c> +- |a| r``.

Two descents visit the trees, for the positives (the first rows of the anchor's
label) and for the negatives (the first rows of other labels in each positive's
window of scores). Both go best first, by the upper bound, over all trees of a task:
nodes outside every window, below the worst of a full list, or without a row of a
label in question are skipped; rows of the leaves left are scored exactly. Lists
are merged by rank over the tasks. The anchors, a stated query set, meet the trees in
blocks: a task holds ``TREES`` trees and ``ANCHORS`` anchors at most, so neither a hot
label nor a large anchor set is gathered in one.

Components are integers (a query scales and floors them). Scores of up to 2**53
are exact in double precision; larger ones are added up as whole numbers, and one that
doesn't fit a long counts as the nearest long.

Edge cases: rows with a null id, label or vector, or with a null or non-finite
component take no part. Rows of different vector lengths never meet; empty
vectors have the score 0. Rows that are equal in id, label and vector count once;
one id with several vectors is as many rows, and rows of the anchor's id are not
its positives. Ties go to the smaller id. Fewer rows than asked for: all of them.
An anchor without positives, or a positive without negatives in its window (a
negative positive score has an empty one), gives no row; so does an empty table.
Other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import cut

POSITIVES = 5
NEGATIVES = 10
LOW_PERCENT, HIGH_PERCENT = 30, 90
TREE_ROWS = 2048
TREES = 32                           # trees of a task, at most
CELLS = 64                           # tasks at least, where there are so many trees
ANCHORS = 4096                       # anchors of a task, at most
LEAF = 8                             # a node with so few rows has no children
EXACT = 2.0 ** 53
SLACK = 1e-6                         # of |a| times the largest norm; well over the rounding of a bound
LONG = (1 << 63) - 1

_TREE = ("dim int, shard int, x array<double>, ids array<long>, names array<string>, label array<int>, first array<int>, "
         "last array<int>, child array<int>, end array<int>, radius array<double>, low array<int>, high array<int>")
_HIT = "anchor long, slot int, score long, vec_id long"


def build(x: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
    """A cover tree of the rows of x: their order, and per node its rows ``first .. last`` in that order, its
    children ``child .. end``, its radius and its smallest and largest label. A node's first row is its centre."""
    norm = np.einsum("ij,ij->i", x, x)
    top = norm.max(initial=0.0)
    y = np.column_stack([x, np.sqrt(np.maximum(top - norm, 0))])
    apart = np.sqrt(np.maximum(2 * top - 2 * (y @ y.T), 0))
    order = np.arange(len(x))
    first, last, child, end, radius = [0], [len(x)], [], [], []
    for node in iter(range(1 << 62)):
        if node == len(first):
            break
        rows = order[first[node]:last[node]]
        radius.append(apart[rows[0], rows].max())
        child.append(len(first))
        if len(rows) > LEAF and radius[node] > 0:
            covers, rest, at = radius[node] / 2, rows, first[node]
            groups = []
            while len(rest):
                near = apart[rest[0], rest] <= covers
                near[0] = True
                groups.append(rest[near])
                first.append(at)
                at += len(groups[-1])
                last.append(at)
                rest = rest[~near]
            order[first[node]:last[node]] = np.concatenate(groups)
        end.append(len(first))
    tree = {k: np.array(v) for k, v in (("first", first), ("last", last), ("child", child), ("end", end))}
    own = label[order]
    spans = list(zip(first, last, strict=True))
    return tree | {"order": order, "radius": np.array(radius), "low": np.array([own[a:b].min() for a, b in spans]),
                   "high": np.array([own[a:b].max() for a, b in spans])}


def _index(table: pa.Table) -> pa.Table:
    """The tree of one shard as one row."""
    dim, shard = (table.column(c)[0].as_py() for c in ("dim", "shard"))
    table = table.sort_by([("vec_id", "ascending")])
    x = np.asarray(table.column("vector").combine_chunks().flatten(), np.float64).reshape(table.num_rows, dim)
    names, label = np.unique(np.array(table.column("label").to_pylist(), object), return_inverse=True)
    tree = build(x, label)
    order = tree.pop("order")
    ids = np.asarray(table.column("vec_id"))[order]
    ints = {k: v.astype(np.int32) for k, v in tree.items() if k != "radius"}
    row = {"dim": dim, "shard": shard, "x": x[order].ravel(), "ids": ids, "names": names.tolist(),
           "label": label[order].astype(np.int32), "radius": tree["radius"], **ints}
    schema = pa.schema([(k, pa.int32() if t == "int" else pa.list_(_ARROW[t[6:-1]]))
                        for k, t in (c.split(" ") for c in _TREE.split(", "))])
    return pa.table({f.name: pa.array([row[f.name]], f.type) for f in schema}, schema)


_ARROW = {"double": pa.float64(), "long": pa.int64(), "int": pa.int32(), "string": pa.string()}


class Tree:
    """A row of the index as arrays."""

    def __init__(self, row: dict) -> None:
        for name in ("ids", "label", "first", "last", "child", "end", "radius", "low", "high"):
            setattr(self, name, np.asarray(row[name].values))
        self.x = np.asarray(row["x"].values).reshape(len(self.ids), -1)
        self.code = {name: k for k, name in enumerate(row["names"].as_py())}
        self.top = np.sqrt(np.einsum("ij,ij->i", self.x, self.x).max(initial=0.0))

    def scores(self, rows: np.ndarray, a: np.ndarray, length: float) -> np.ndarray:
        """Exact inner products: doubles where those are exact, else whole numbers of any size."""
        if length * self.top < EXACT:
            return self.x[rows] @ a
        whole = [int(v) for v in a]
        return np.array([sum(int(p) * q for p, q in zip(row, whole, strict=True)) for row in self.x[rows]] or [0], object)[:len(rows)]


def descend(trees: list[Tree], a: np.ndarray, label: str, own_id: int, windows: list[tuple[float, float]], k: int,
            same: bool) -> list[list[tuple[int, int]]]:
    """For each window of scores the first k (score, id) of the trees' rows of the label, or of the others."""
    length = float(np.sqrt(a @ a))
    best: list[list[tuple[int, int]]] = [[] for _ in windows]      # (-score, id), in order
    floor = [low for low, _ in windows]
    high = np.array([float(h) for _, h in windows])

    def seen(up: np.ndarray, down: np.ndarray) -> np.ndarray:
        return ((up[:, None] >= np.array([float(f) for f in floor])) & (down[:, None] <= high)).any(axis=1)

    def verify(tree: Tree, rows: np.ndarray, code: int) -> None:
        ok = tree.label[rows] == code
        rows = rows[ok & (tree.ids[rows] != own_id)] if same else rows[~ok]
        score = tree.scores(rows, a, length)
        for w, (_, top) in enumerate(windows):
            at = np.flatnonzero((score >= floor[w]) & (score <= top))
            if len(at) > k:
                at = at[score[at] >= np.partition(score[at], len(at) - k)[len(at) - k]]
            if len(at):
                new = [(-int(s), i) for s, i in zip(score[at].tolist(), tree.ids[rows[at]].tolist(), strict=True)]
                best[w] = sorted(best[w] + new)[:k]
                if len(best[w]) == k:
                    floor[w] = max(floor[w], -best[w][-1][0])

    def offer(number: int, nodes: np.ndarray) -> None:
        """Score the leaves among the nodes that may hold a result, best first, and queue the other nodes."""
        tree = trees[number]
        code = tree.code.get(label, -1)
        if same:
            nodes = nodes[(tree.low[nodes] <= code) & (code <= tree.high[nodes])]
        else:
            nodes = nodes[(tree.low[nodes] != code) | (tree.high[nodes] != code)]
        centre = tree.x[tree.first[nodes]] @ a
        reach = length * (tree.radius[nodes] + SLACK * tree.top)
        up, down = centre + reach, centre - reach
        keep = seen(up, down)
        leaf = tree.child[nodes] == tree.end[nodes]
        for n, u, d in zip(nodes[keep & ~leaf].tolist(), up[keep & ~leaf].tolist(), down[keep & ~leaf].tolist(), strict=True):
            heapq.heappush(heap, (-u, d, number, n))
        leaves = nodes[keep & leaf]
        size = tree.last[leaves] - tree.first[leaves]
        if len(leaves):
            starts = np.repeat(tree.first[leaves] - np.cumsum(size) + size, size)
            verify(tree, starts + np.arange(len(starts)), code)

    heap: list[tuple[float, float, int, int]] = []
    for number in range(len(trees)):
        offer(number, np.zeros(1, np.int64))
    while heap:
        up, down, number, node = heapq.heappop(heap)
        if -up < min(float(f) for f in floor):
            break
        if seen(np.array([-up]), np.array([down]))[0]:
            offer(number, np.arange(trees[number].child[node], trees[number].end[node]))
    return [[(-s, i) for s, i in b] for b in best]


def _search(k: int, same: bool, low: int = 0, high: int = 0):
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            trees = [Tree({c: left.column(c)[i] for c in left.column_names}) for i in range(left.num_rows)]
            x = right.column("vector").combine_chunks()
            for i, (key, own, label) in enumerate(zip(*(right.column(c).to_pylist() for c in ("anchor", "vec_id", "label")),
                                                      strict=True)):
                windows = [(float("-inf"), float("inf"))]
                if not same:
                    # low * p <= 100 * score <= high * p, in whole numbers
                    windows = [(-(-low * p // 100), high * p // 100) for p in right.column("scores")[i].as_py()]
                a = np.asarray(x[i].values, np.float64)
                for slot, found in enumerate(descend(trees, a, label, own, windows, k, same)):
                    out.extend((key, slot, min(max(s, -LONG - 1), LONG), j) for s, j in found)
        columns = list(zip(*out, strict=True)) or [[]] * 4
        return pa.table({"anchor": pa.array(columns[0], pa.int64()), "slot": pa.array(columns[1], pa.int32()),
                         "score": pa.array(columns[2], pa.int64()), "vec_id": pa.array(columns[3], pa.int64())})
    return search


def index(rows: DataFrame, shards: int) -> DataFrame:
    """One tree a shard, of all rows of (vec_id, label, vector, dim)."""
    shard = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).cast("int")
    return rows.withColumn("shard", shard).groupBy("dim", "shard").applyInArrow(_index, _TREE)


def _met(trees: DataFrame, anchors: DataFrame, cells: int, blocks: int, search) -> DataFrame:
    """Every anchor meets every tree of its dimension: trees are repeated to the blocks of anchors, anchors to the cells."""
    left = trees.withColumn("cell", F.col("shard") % cells).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = anchors.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks)).cast("int")).withColumn(
        "cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
    keys = ["dim", "cell", "block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, _HIT)


def _first(hits: DataFrame, keys: list[str], n: int) -> DataFrame:
    place = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= n)


def hard_negatives(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low_percent: int = LOW_PERCENT, high_percent: int = HIGH_PERCENT, tree_rows: int = TREE_ROWS,
                   anchors_each: int = ANCHORS, trees_each: int = TREES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on the named columns of ``rows``.
    """
    vector = F.col(f"`{vector_col}`")
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    valid = (F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull() & F.coalesce(finite, F.lit(False)))
    rows = cut(rows.where(valid).select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("string").alias("label"),
        vector.cast("array<double>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
        .distinct().withColumn("dim", F.size("vector")))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_anchor").alias("anchors")).first()
    shards = max(1, -(-size["n"] // tree_rows))
    cells = max(-(-shards // trees_each), min(shards, CELLS))
    blocks = max(1, -(-size["anchors"] // anchors_each))

    trees = cut(index(rows.drop("is_anchor"), shards))
    anchors = cut(rows.where("is_anchor").select(F.monotonically_increasing_id().alias("anchor"), "vec_id", "label", "vector", "dim"))
    near = _first(_met(trees, anchors, cells, blocks, _search(positives, True)), ["anchor"], positives)
    near = cut(near.select("anchor", (F.col("rank") - 1).alias("slot"), F.col("score").alias("positive_score"),
                           F.col("vec_id").alias("positive_id")))
    scores = near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("slot", "positive_score"))).alias("s"))
    asking = anchors.join(scores, "anchor").withColumn("scores", F.transform("s", lambda s: s["positive_score"])).drop("s")
    far = _first(_met(trees, asking, cells, blocks, _search(negatives, False, low_percent, high_percent)),
                 ["anchor", "slot"], negatives)
    return (far.join(near, ["anchor", "slot"]).join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))
