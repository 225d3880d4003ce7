"""Shared plumbing of the operators: inputs, lineage cuts and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import checkpoint_dir

FEW = 20_000                         # edges from which on a graph is small: 16 bytes an edge, twice
ROWS = 20_000                        # narrow rows that are worth a task of their own
SIEVE_BITS = 32                      # bits an id in a sieve: about 3 % of the other rows pass
SIEVE_MOST = 1 << 26                 # bits of the largest sieve, 8 MB; with more ids more of the others pass
SIEVE_ROW = 1 << 15                  # bits of one row of ``bitmap_construct_agg``
SIEVE_TASK = 1_000_000               # ids that one task sets in a sieve


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                carry: tuple[str, ...] = ()) -> DataFrame:
    """Only the two columns that an operator reads, under fixed names, so that others can't clash;
    with ``carry`` also a struct ``rest`` of the named columns."""
    out = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                      F.col(f"`{text_col}`").cast("string").alias("text"),
                      *([F.struct(*(F.col(f"`{c}`").alias(c) for c in carry)).alias("rest")] if carry else []))
    return out


def rest_type(frame: DataFrame) -> str:
    """The type of the carried struct, for a schema string."""
    return frame.schema["rest"].dataType.simpleString()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage at a reliable checkpoint in the shared folder of ``spark.checkpoint.dir``."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def tasks(rows: int, least: int = 1) -> int:
    """Partitions for that many narrow rows. What a checkpoint wrote is read in as many partitions as the shuffle
    before it had, most of them nearly empty on small tables; each is a task and three shuffle files in all steps after."""
    return max(least, -(-rows // ROWS))


def salt(by: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(by), F.lit(n)).cast("int")


def salted_join(rows: DataFrame, table: DataFrame, keys: list[str], by: str, n: int = 4) -> DataFrame:
    """Inner join of rows, which may be very many to a key, with a table of one row to a key.

    The table is repeated for ``n`` salts drawn from ``by``; a hot key is spread, and as
    both sides are dealt anew for the join, AQE can split what is still skewed.
    """
    spread = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return rows.withColumn("_salt", salt(F.col(by), n)).join(spread, [*keys, "_salt"]).drop("_salt")


def sieved(rows: DataFrame, by: str, ids: DataFrame, id_col: str, n: int) -> DataFrame:
    """The rows whose ``by`` is one of the ``n`` ids (or fewer), and a few others: without a shuffle of the rows, which may hold texts.

    Ids that fit a task are broadcast themselves and no other row passes. More are hashed to a bitmap of at most
    ``SIEVE_MOST`` bits, which is broadcast; an exact join is up to the caller.
    """
    if tasks(n) == 1:
        return rows.join(F.broadcast(ids.select(F.col(id_col).alias("_id"))), F.col(by) == F.col("_id"), "left_semi")
    slots = min(SIEVE_MOST, max(1, n) * SIEVE_BITS)

    def slot(column: str) -> Column:
        return F.pmod(F.xxhash64(F.col(column)), F.lit(slots))
    bits = ids.select(slot(id_col).alias("slot")).select(
        F.floor(F.col("slot") / SIEVE_ROW).alias("_part"), F.pmod(F.col("slot"), F.lit(SIEVE_ROW)).alias("bit"))
    parts = -(-n // SIEVE_TASK)                          # one: the bitmaps need no exchange
    bits = bits.coalesce(1) if parts == 1 else bits.repartition(parts, "_part")
    bitmaps = bits.groupBy("_part").agg(F.bitmap_construct_agg("bit").alias("_bits"))
    # exploded, so that the optimizer carries no constraints on hashes of the id into every later join
    placed = rows.withColumn("_slot", F.explode(F.array(slot(by))))
    byte = F.expr(f"substring(_bits, cast(pmod(_slot, {SIEVE_ROW}) div 8 as int) + 1, 1)")
    return (placed.withColumn("_part", F.floor(F.col("_slot") / SIEVE_ROW)).join(F.broadcast(bitmaps), "_part")
            .where(F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), F.pmod("_slot", F.lit(8)).cast("int")) == 1)
            .select(*rows.columns))


def salted_left_join(rows: DataFrame, table: DataFrame, keys: list[str], n: int = 4) -> DataFrame:
    """Left join of rows, which may be very many to a key or have null keys, with a table of one row to a key."""
    spread = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return rows.withColumn("_salt", salt(F.monotonically_increasing_id(), n)).join(
        spread, [*keys, "_salt"], "left").drop("_salt")


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of an edge list: (node, label), label the smallest node reachable.

    Contraction: every node hooks to its smallest neighbour, pointer doubling takes it
    to the end of its chain of hooks, and the edges move to those ends; the rest is
    repeated until no edge is left. Labels only ever get smaller, so there are no
    cycles; a path of n nodes takes about log n jumps. Each step is checkpointed. A graph of at most ``FEW``
    edges is one partition and joins by broadcast, so its steps need no exchange. Duplicate edges and loops are harmless; null ends are dropped;
    without edges the result is empty.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    live = cut(both.union(both.select("v", "u").toDF("u", "v")).distinct())
    left = live.count()
    few = left <= 2 * FEW                                # both directions; no step has more rows than the edges

    parts = 1 if few else tasks(left, 2)

    def step(df: DataFrame) -> DataFrame:
        return cut(df).coalesce(parts)

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if few else df
    live = live.coalesce(parts)
    steps = []
    while left:
        if len(steps) == max_rounds:
            raise RuntimeError("connected components did not converge")
        jumped = step(live.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("node"), F.least("u", "m").alias("to")))
        moved = True
        while moved:                 # pointer doubling: a chain of n hooks takes log n jumps
            up = jumped.select(F.col("node").alias("mid"), F.col("to").alias("top"))
            far = step(jumped.join(small(up), jumped["to"] == up["mid"]).select("node", "to", "top"))
            moved = not far.where("top <> to").isEmpty()
            jumped = far.select("node", F.col("top").alias("to"))
        steps.append(jumped)
        lower = jumped.select(F.col("node").alias("u"), F.col("to").alias("nu"))
        upper = jumped.select(F.col("node").alias("v"), F.col("to").alias("nv"))
        live = step(live.join(small(lower), "u").join(small(upper), "v").where("nu <> nv")
                    .select(F.col("nu").alias("u"), F.col("nv").alias("v")).distinct())
        left = live.count()
    if not steps:
        return live.select(F.col("u").alias("node"), F.col("v").alias("label"))
    labels = steps[0].select("node", F.col("to").alias("label"))
    for jumped in steps[1:]:
        labels = relabelled(labels, jumped.select("node", F.col("to").alias("label")), few)
    return labels if len(steps) == 1 else step(labels)


def relabelled(labels: DataFrame, new: DataFrame, few: bool = False) -> DataFrame:
    """(node, label) with every label replaced by its own label in ``new``, where it has one; ``few``: ``new`` is known to be small."""
    step = new.select(F.col("node").alias("_old"), F.col("label").alias("_new"))
    return (labels.join(F.broadcast(step) if few else step, labels["label"] == step["_old"], "left")
            .select("node", F.coalesce("_new", "label").alias("label")))


def merged_labels(labels: DataFrame, edges: DataFrame, parts: int) -> DataFrame:
    """The component labels of all nodes after more edges (a, b) between them; ``labels`` has every node.

    ``parts``: ``tasks`` of the nodes; those of one task are broadcast.
    """
    few = parts == 1
    a = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    b = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    a, b = (F.broadcast(a), F.broadcast(b)) if few else (a, b)
    between = edges.join(a, "a").join(b, "b").where("la <> lb").select("la", "lb")
    return cut(relabelled(labels, components(between, "la", "lb"), few)).coalesce(parts)
