"""Operator 12: near-duplicate vectors by collision counting on one-dimensional projections.

Vectors of one label and length form a group; links are pairs of a group with a
cosine of at least ``THRESHOLD``. Unit vectors are projected on ``PROJECTIONS`` random
directions and each projection is sorted. Around every vector lies a window of
``SPREAD`` standard deviations of the difference that a pair at the threshold has;
two vectors that lie in each other's window collide there. Pairs that collide at
least as often as a pair at the threshold does with probability ``RECALL`` (an
exact binomial tail) are verified by their cosine in double precision, so no link
is below the threshold.

Counting all pairs of a group grows with its square, so large groups are routed
first: in each of several tables a few more projections are cut at the group's
mean, and windows are counted within a *cell* of about ``CELL_ROWS`` vectors. The
number of cuts and tables is the cheapest that puts a pair at the threshold into
one cell with probability ``RECALL``, from the group's size and spread; a group of
up to ``CELL_ROWS`` vectors is one cell and loses nothing there. A pair that meets in
several tables counts in the first.

No pair list leaves a cell: it gives a count per vector and a spanning forest.
Equal vectors are one class with a count. Where a cell is crowded, the vectors
within half of the threshold's angle of its mean direction are one *ball*: all of
them link with each other, a ball is searched as one vector with a radius, and
the triangle inequality of angles settles most of its meetings; only the rest is
verified vector by vector, in blocks. What still crowds a cell is dealt in pairs of
blocks.

Edge cases: null, zero or empty vectors, vectors that hold null or non-finite
components, and rows with a null label link with nothing (``n_links`` 0, a component
of their own). Rows with a null id are returned, never linked (``component_id`` null,
``kept`` true). Vectors of different length never link. Repeated rows (equal id, label
and vector) are each returned and count as one vector; one id with several
vectors is as many vectors. An empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import components, cut, salted_join, salted_left_join

THRESHOLD = 0.93
PROJECTIONS = 24
SPREAD = 1.0
RECALL = 0.995
CELL_ROWS = 1024
CROWDED = 4                          # times CELL_ROWS: a cell with so many vectors is looked at for a ball
MAX_TABLES, MAX_CUTS = 64, 40
SEED = 12
EPS = 1e-9                           # radians; a bound that is closer than this to the angle is verified

#: Kinds of rows that a cell gives: links of every vector of a unit, links of one vector, an edge, an open pair.
COUNT, OWN, EDGE, UNSURE = 0, 1, 2, 3
_FOUND = "node long, other long, n long, kind int"


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The rows of a list column, all of one length, as unit vectors in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = np.asarray(column.flatten(), np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, initial=0, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


@functools.lru_cache(maxsize=256)
def directions(dim: int, table: int, n: int) -> np.ndarray:
    """``n`` random directions as columns; ``table`` -1 for the counted ones, else those that are cut."""
    return np.random.default_rng([SEED, dim, table + 1]).standard_normal((n, dim)).T


def distance(angle: float) -> float:
    """Of two unit vectors at an angle."""
    return 2 * math.sin(min(angle, math.pi) / 2)


@functools.lru_cache(maxsize=1)
def least_collisions() -> int:
    """The largest count that a pair at the threshold reaches with probability ``RECALL``."""
    p = math.erf(SPREAD / math.sqrt(2))
    tail = 1.0
    for k in range(PROJECTIONS + 1):
        tail -= math.comb(PROJECTIONS, k) * p ** k * (1 - p) ** (PROJECTIONS - k)
        if tail < RECALL:
            return k
    return PROJECTIONS


def routing(n: int, spread: float, angle: float, cell_rows: int) -> tuple[int, int]:
    """(cuts, tables) of least work for a group of ``n`` vectors whose squared distance to the mean is ``spread``."""
    similar = 1 - distance(angle) ** 2 / (2 * max(spread, 1e-12))
    agree = 1 - math.acos(min(1.0, max(-1.0, similar))) / math.pi
    best = (float(n), 0, 1)
    for cuts in range(1, MAX_CUTS + 1):
        if n <= cell_rows << (cuts - 1):
            break
        together = agree ** cuts
        tables = math.ceil(math.log(1 - RECALL) / math.log1p(-together)) if 0 < together < 1 else math.inf
        if tables > MAX_TABLES:
            break
        best = min(best, (tables * n / 2 ** cuts, cuts, tables))
    return best[1:]


def candidates(x: np.ndarray, angle: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a < b) of rows that collide often enough in the windows around them."""
    n = len(x)
    half = SPREAD * distance(angle)
    projected = x @ directions(x.shape[1], -1, PROJECTIONS)
    counts = np.zeros(n * n, np.uint8)
    for line in projected.T:
        order = np.argsort(line, kind="stable")
        line = line[order]
        reach = np.searchsorted(line, line + half, "right") - np.arange(n) - 1
        first = np.repeat(np.arange(n), reach)
        second = np.arange(len(first)) - np.repeat(np.cumsum(reach) - reach, reach) + first + 1
        a, b = order[first], order[second]
        counts[np.minimum(a, b) * n + np.maximum(a, b)] += 1      # a pair stands here at most once
    return np.divmod(np.flatnonzero(counts >= least_collisions()), n)


def cosines(x: np.ndarray, a: np.ndarray, b: np.ndarray, step: int = 1 << 16) -> np.ndarray:
    return np.concatenate([np.zeros(0), *(np.einsum("ij,ij->i", x[a[k:k + step]], x[b[k:k + step]])
                                          for k in range(0, len(a), step))])


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest one that the links (a, b) reach."""
    low = np.arange(n)
    while len(a):
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        new = new[new]
        if (new == low).all():
            break
        low = new
    return low


def _rows(*parts: tuple[np.ndarray, np.ndarray | None, np.ndarray | int, int]) -> pa.Table:
    """A table of ``_FOUND`` from (node, other, n, kind)."""
    size = [len(p[0]) for p in parts]
    return pa.table({
        "node": pa.array(np.concatenate([p[0] for p in parts]), pa.int64()),
        "other": pa.concat_arrays([pa.nulls(k, pa.int64()) if p[1] is None else pa.array(p[1], pa.int64())
                                   for p, k in zip(parts, size, strict=True)]),
        "n": pa.array(np.concatenate([np.broadcast_to(np.asarray(p[2], np.int64), k)
                                      for p, k in zip(parts, size, strict=True)])),
        "kind": pa.array(np.repeat([p[3] for p in parts], size), pa.int32())})


def _linked(node: np.ndarray, weight: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple:
    """Rows of the links (a, b): how much each node links, and a spanning forest."""
    n = np.bincount(a, weight[b], len(node)) + np.bincount(b, weight[a], len(node))
    low, some = forest(len(node), a, b), np.flatnonzero(n)
    tree = np.flatnonzero(low != np.arange(len(node)))
    return (node[some], None, n[some].astype(np.int64), COUNT), (node[tree], node[low[tree]], 0, EDGE)


def _compare(threshold: float):
    """What one cell, or a pair of blocks of it, finds."""
    limit = math.acos(threshold)

    def compare(table: pa.Table) -> pa.Table:
        t, i, j = (table.column(c)[0].as_py() for c in ("t", "i", "j"))
        node, size, radius, mine = (np.asarray(table.column(c)) for c in ("node", "size", "radius", "mine"))
        x = matrix(table.column("vector"))
        a, b = candidates(x, limit + 2 * float(table.column("wide")[0].as_py()))
        if i != j:
            keep = mine[a] != mine[b]
            a, b = a[keep], b[keep]
        if t:
            codes = np.asarray(table.column("codes").combine_chunks().flatten()).reshape(len(node), -1)[:, :t]
            keep = ~np.concatenate([np.zeros(0, bool), *((codes[a[k:k + 65536]] == codes[b[k:k + 65536]]).any(axis=1)
                                                         for k in range(0, len(a), 65536))])
            a, b = a[keep], b[keep]
        cosine = cosines(x, a, b)
        link, unsure = cosine >= threshold, np.zeros(len(a), bool)
        reach = radius[a] + radius[b]
        if reach.any():
            angle = np.arccos(np.clip(cosine, -1, 1))
            wide = reach > 0
            link = np.where(wide, angle + reach < limit - EPS, link)
            unsure = wide & ~link & (angle - reach <= limit + EPS)
        return _rows(*_linked(node, size, a[link], b[link]),
                     (node[a[unsure]], node[b[unsure]], 0, UNSURE))
    return compare


def _meet(threshold: float):
    """What the vectors of two units find in a pair of blocks; every vector of one is held against every one of the other."""
    def meet(table: pa.Table) -> pa.Table:
        left = np.asarray(table.column("left"))
        node, copies, unit = (np.asarray(table.column(c)) for c in ("node", "copies", "unit"))
        x = matrix(table.column("vector"))
        p, q = np.flatnonzero(left), np.flatnonzero(~left)
        linked = x[p] @ x[q].T >= threshold
        n = np.zeros(len(node), np.int64)
        n[p], n[q] = linked @ copies[q], copies[p] @ linked
        some = np.flatnonzero(n)
        ends = [unit[p[:1]], unit[q[:1]]] if linked.any() else [unit[:0], unit[:0]]
        return _rows((node[some], None, n[some], OWN), (*ends, 0, EDGE))
    return meet


def vector_sums(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, mean): the sum of the unit vectors of each key over its count, added up batch by batch first."""
    types = dict(rows.dtypes)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            if not batch.num_rows:
                continue
            key = pa.Table.from_batches([batch.select(keys)]).to_pandas().groupby(keys, sort=False).ngroup().to_numpy()
            first = np.unique(key, return_index=True)[1]
            lengths = np.asarray(pa.compute.list_value_length(batch.column("vector")))
            sums = [None] * len(first)
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                x = matrix(batch.column("vector").take(pa.array(at)))
                for g in np.unique(key[at]):
                    own = x[key[at] == g]
                    sums[g] = np.append(own.sum(axis=0), len(own))
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).take(pa.array(first)) for k in keys] + [pa.array(sums, pa.list_(pa.float64()))],
                [*keys, "sums"])
    partial = rows.select(*keys, "vector").mapInArrow(
        batches, ", ".join(f"{k} {types[k]}" for k in keys) + ", sums array<double>")
    summed = (partial.select(*keys, F.posexplode("sums").alias("at", "v")).groupBy(*keys, "at").agg(F.sum("v").alias("v"))
              .groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda s: s["v"]).alias("s")))
    n = F.element_at("s", -1)
    return summed.select(*keys, n.cast("long").alias("n"),
                         F.transform(F.slice("s", F.lit(1), F.size("s") - 1), lambda v: v / n).alias("mean"))


def _routed(units: DataFrame, stats: DataFrame, threshold: float, cell_rows: int) -> DataFrame:
    """Units with (codes, wide): their cell in every table; units of small groups have one."""
    limit = math.acos(threshold)
    types = dict(units.dtypes)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            codes = [[0]] * batch.num_rows
            wide = np.nan_to_num(np.asarray(batch.column("wide").to_numpy(zero_copy_only=False), np.float64))
            group = batch.column("g").to_numpy(zero_copy_only=False)
            for g in np.unique(group[~np.isnan(group)]) if len(group) else []:
                at = np.flatnonzero(group == g)
                mean = np.asarray(batch.column("mean")[int(at[0])].as_py())
                x = matrix(batch.column("vector").take(pa.array(at)))
                cuts, tables = routing(batch.column("n")[int(at[0])].as_py(), 1 - float(mean @ mean),
                                       limit + 2 * wide[at[0]], cell_rows)
                own = np.zeros((len(at), tables), np.int64)
                for t in range(tables if cuts else 0):
                    side = (x - mean) @ directions(x.shape[1], t, MAX_CUTS)[:, :cuts] > 0
                    own[:, t] = side @ (1 << np.arange(cuts))
                for k, row in zip(at, own.tolist(), strict=True):
                    codes[k] = row
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in types] + [pa.array(codes, pa.list_(pa.int64())), pa.array(wide)],
                [*types, "codes", "wide"])
    joined = salted_left_join(units, stats, ["label", "dim"])
    return joined.select(*types, "g", F.col("n").cast("long").alias("n"), "mean", "wide").mapInArrow(
        batches, ", ".join(f"{c} {k}" for c, k in types.items()) + ", codes array<long>, wide double")


def _balls(routed: DataFrame, threshold: float, cell_rows: int, crowded: int) -> DataFrame | None:
    """(unit, node, angle, centre) of the vectors that crowd a cell of the first table around its mean; None without any."""
    cells = routed.select("label", "dim", F.col("codes")[0].alias("cell"), "node", "vector")
    heavy = (cells.groupBy("label", "dim", "cell").count().where(F.col("count") > crowded * cell_rows)
             .select("label", "dim", "cell", F.monotonically_increasing_id().alias("ball")))
    heavy = cut(heavy)
    if heavy.isEmpty():
        return None
    inside = salted_join(cells, heavy, ["label", "dim", "cell"], "node")
    centres = cut(vector_sums(inside, ["ball"]).select("ball", F.col("mean").alias("centre")))
    half = math.acos(threshold) / 2 - EPS

    def angles(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            length = np.asarray(pa.compute.list_value_length(batch.column("vector")))
            angle = np.full(batch.num_rows, np.pi)
            for d in np.unique(length):
                at = np.flatnonzero(length == d)
                x, c = (matrix(batch.column(k).take(pa.array(at))) for k in ("vector", "centre"))
                angle[at] = np.arccos(np.clip(np.einsum("ij,ij->i", x, c), -1, 1))
            keep = pa.array(angle <= half)      # false where the centre has no direction
            out = batch.append_column("angle", pa.array(angle)).filter(keep)
            yield out.select(["ball", "node", "angle", "centre"])
    near = cut(salted_join(inside.select("ball", "node", "vector"), centres, ["ball"], "node").mapInArrow(
        angles, "ball long, node long, angle double, centre array<double>"))
    unit = near.groupBy("ball").agg(F.min("node").alias("unit"))
    return cut(salted_join(near, unit, ["ball"], "node").select("unit", "node", "angle", "centre"))


def _dealt(routed: DataFrame, cell_rows: int) -> DataFrame:
    """A row for each table and, in cells of more than twice ``cell_rows``, for each pair of blocks."""
    at = routed.select("*", F.posexplode("codes").alias("t", "cell"))
    large = (at.groupBy("label", "dim", "t", "cell").agg(F.count(F.lit(1)).alias("of")).where(F.col("of") > 2 * cell_rows)
             .select("label", "dim", "t", "cell", F.ceil(F.col("of") / cell_rows).cast("int").alias("blocks")))
    rows = salted_left_join(at, large, ["label", "dim", "t", "cell"])
    rows = rows.withColumn("mine", F.coalesce(F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.lit(0)))
    pairs = F.transform(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1), lambda k: F.struct(
        F.least(k, "mine").alias("i"), F.greatest(k, "mine").alias("j")))
    return rows.withColumn("pair", F.explode(pairs)).select("*", "pair.*").drop("pair", "blocks")


def _settled(unsure: DataFrame, vectors: DataFrame, cell_rows: int, threshold: float) -> DataFrame:
    """Rows of ``_FOUND`` from the vectors of pairs of units that their bounds leave open.

    ``vectors``: (unit, node, vector, copies, block), ``block`` below ``blocks`` of its unit.
    """
    blocks = vectors.groupBy("unit").agg(F.max("block").alias("last"))
    pairs = cut(unsure.select(F.col("node").alias("a"), F.col("other").alias("b"))
                .join(blocks.toDF("a", "last_a"), "a").join(blocks.toDF("b", "last_b"), "b")
                .withColumn("i", F.explode(F.sequence(F.lit(0), "last_a")))
                .withColumn("j", F.explode(F.sequence(F.lit(0), "last_b"))).select("a", "b", "i", "j"))
    sides = [pairs.select("a", "b", "i", "j", F.col(u).alias("unit"), F.col(k).alias("block"))
             .join(vectors, ["unit", "block"]).withColumn("left", F.lit(u == "a")) for u, k in (("a", "i"), ("b", "j"))]
    return sides[0].union(sides[1]).groupBy("a", "b", "i", "j").applyInArrow(_meet(threshold), _FOUND)


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 threshold: float = THRESHOLD, cell_rows: int = CELL_ROWS, crowded: int = CROWDED) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row."""
    vector = F.col(f"`{vector_col}`")
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    valid = (F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull()
             & F.coalesce(finite & F.exists(vector, lambda v: v != 0), F.lit(False)))
    rows = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                       F.when(valid, F.col(f"`{label_col}`").cast("string")).alias("label"),
                       F.when(valid, vector).alias("vector"))
    rows = rows.withColumns({"h1": F.when(F.col("label").isNotNull(), F.xxhash64("label", "vector")),
                             "h2": F.when(F.col("label").isNotNull(), F.xxhash64(F.lit(SEED), "label", "vector"))})
    classes = cut(rows.where("label is not null").distinct().groupBy("h1", "h2", "label", "vector")
                  .agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
                  .select("*", F.monotonically_increasing_id().alias("node"), F.size("vector").alias("dim")))

    large = classes.groupBy("label", "dim").count().where(F.col("count") > cell_rows).select("label", "dim")
    stats = cut(vector_sums(salted_join(classes, large, ["label", "dim"], "node"), ["label", "dim"])
                .select("*", F.monotonically_increasing_id().cast("double").alias("g"), F.lit(0.0).alias("wide")))
    units = classes.select("label", "dim", "node", "vector", F.col("copies").alias("size"), F.lit(0.0).alias("radius"))
    routed = cut(_routed(units, stats, threshold, cell_rows))
    members = None if stats.isEmpty() else _balls(routed, threshold, cell_rows, crowded)
    if members is not None:
        whole = (members.join(units.drop("radius"), "node").groupBy("unit")
                 .agg(F.first("label").alias("label"), F.first("dim").alias("dim"), F.first("centre").alias("vector"),
                      F.sum("size").alias("size"), F.max("angle").alias("radius")))
        whole = cut(whole.withColumnRenamed("unit", "node"))
        wide = whole.groupBy("label", "dim").agg(F.max("radius").alias("wide"))
        stats = cut(stats.drop("wide").join(wide, ["label", "dim"], "left").fillna(0.0, ["wide"]))
        single = units.join(members.select("node"), "node", "left_anti")
        units = cut(single.withColumn("vector", F.col("vector").cast("array<double>")).unionByName(whole))
        routed = cut(_routed(units, stats, threshold, cell_rows))
    found = cut(_dealt(routed, cell_rows).groupBy("label", "dim", "t", "cell", "i", "j")
                .applyInArrow(_compare(threshold), _FOUND))
    owner = classes.select("node", F.col("node").alias("unit"), F.lit(0).cast("long").alias("others"))
    if members is not None:
        sizes = units.where("radius > 0").select(
            F.col("node").alias("unit"), "size", F.ceil(F.col("size") / cell_rows).alias("blocks"))
        inside = salted_join(members.select("unit", "node"), sizes, ["unit"], "node")
        own = cut(classes.join(inside, "node", "left").select(
            "node", F.coalesce("unit", "node").alias("unit"), "vector", "copies",
            F.coalesce(F.col("size") - F.col("copies"), F.lit(0)).alias("others"),
            F.coalesce(F.pmod(F.xxhash64("node"), "blocks").cast("int"), F.lit(0)).alias("block")))
        owner = own.select("node", "unit", "others")
        found = cut(found.where(F.col("kind") != UNSURE).union(
            _settled(found.where(F.col("kind") == UNSURE), own.drop("others"), cell_rows, threshold)))
    return _per_row(rows, classes, owner, found)


def _per_row(rows: DataFrame, classes: DataFrame, owner: DataFrame, found: DataFrame) -> DataFrame:
    """The result: links and component of the class of each row."""
    def links(kind: int, key: str) -> DataFrame:
        return (found.where(F.col("kind") == kind).groupBy(F.col("node").alias(key))
                .agg(F.sum("n").alias(f"{key}_links")))
    label = components(found.where(F.col("kind") == EDGE), "node", "other").toDF("unit", "component")
    at = salted_left_join(salted_left_join(
        classes.select("node", "h1", "h2", "first_id", "copies").join(owner, "node").join(links(OWN, "node"), "node", "left"),
        links(COUNT, "unit"), ["unit"]), label, ["unit"]).withColumn("component", F.coalesce("component", "unit"))
    at = cut(at.select("h1", "h2", "first_id", "component", (
        F.col("copies") - 1 + F.col("others") + F.coalesce("unit_links", F.lit(0))
        + F.coalesce("node_links", F.lit(0))).alias("n_links")))
    smallest = at.groupBy("component").agg(F.min("first_id").alias("component_id"))
    known = salted_join(at, smallest, ["component"], "h1").select("h1", "h2", "n_links", "component_id")
    joined = salted_left_join(rows.select("vec_id", "h1", "h2"), known, ["h1", "h2"])
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"),
                         F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
