import collections
import itertools
import re

from helpers_llm import WORDS, edge_rows, frame, prose, table

from daybook.llm import filteraudit as op

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def fails(rows):
    """The set of filters that each (doc_id, text, part) row fails, by plain loops over all rows."""
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    out = []
    for i, text, _ in rows:
        text = text or ""
        words = WORDS.findall(text)
        out.append({f for f, bad in (
            ("A", len(words) < 200), ("B", 100 * len(set(words)) < 50 * len(words)),
            ("C", 100 * len(re.findall("[A-Z]", text)) > 2 * len(text)),
            ("D", re.search(r"[#$%&*|]", text)), ("E", i is not None and first[text] < i)) if bad})
    return out


def brute_force(rows, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    failed, out = fails(rows), {}
    for part in {p or "" for *_, p in rows}:
        mine = [(i, f) for (i, _, p), f in zip(rows, failed, strict=True) if (p or "") == part]
        shapley = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            there = list(mine)
            for step, f in enumerate(order, 1):
                gone = [(i, x) for i, x in there if f in x]
                there = [(i, x) for i, x in there if f not in x]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(there), len(gone), sum(f in x for _, x in mine) - len(gone),
                    sum(x == {f} for _, x in mine), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(shapley[order[step - 1]])
    return sorted((*k, *v) for k, v in out.items())


def result(docs, labels):
    return sorted(tuple(r) for r in op.audit(docs, labels).select(
        "part", "filter_order", "step", *COUNTS, "shapley").collect())


def test_smallest_table_matches_brute_force(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    assert result(docs, labels) == brute_force(rows, [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])


def test_edge_rows_parts_ties_and_labels(spark):
    """Null text, id, part and label, repeated rows and ids, every single filter, white space that only Unicode knows."""
    import random
    rng = random.Random(1)
    clean = prose(rng, 400)
    more = [clean, clean, clean + " #", clean.upper(), "A" * 2 + "é" * 98, "A" * 2 + "é" * 97, "a b c\u0085d " * 100,
            "x\x1cy " * 200, clean, "", None, "\x00 a", clean + "\x0b" + clean]
    texts = [(k + 100, t) for k, t in enumerate(more)] + [(100, clean), (None, clean)] + edge_rows()
    parts = ["a", "", None, "b'\"", "a"]
    rows = [(i, t, parts[k % 5]) for k, (i, t) in enumerate(texts)]
    labels = [(100, 1, 0), (101, 1, 1), (101, 0, None), (102, None, None), (None, 1, 1), (104, 0, 1), (2, 1, 1), (2, 1, 0)]
    docs = spark.createDataFrame([(*r, "n", "m", 3) for r in rows],
                                 "doc_id long, text string, source string, part string, failed string, mask int")
    known = spark.createDataFrame([(*r, 5) for r in labels], "doc_id long, quality int, toxic int, n int")
    assert result(docs, known) == brute_force(rows, labels)


def test_one_text_in_a_third_of_the_rows(spark):
    rows = [(k, "hot text" if k % 3 else f"text {k}", "s") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert result(docs, labels) == brute_force(rows, [])


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert result(frame(spark, []), labels) == []


def test_steps_are_folded_in_sql(spark):
    plan = op.audit(table(spark, "documents"), table(spark, "labels"))._jdf.queryExecution().toString()
    assert "Window" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_salted_labels_are_never_broadcast(spark, tmp_path):
    """A label file under Spark's broadcast limit is salted to many times its rows, which the driver would have to hold."""
    docs = frame(spark, [(k, f"text {k}") for k in range(40)])
    docs.select("doc_id", (docs.doc_id % 2).cast("int").alias("quality"), (docs.doc_id % 3).cast("int").alias("toxic")) \
        .write.parquet(f"{tmp_path}/labels")
    found = op.cells(docs, spark.read.parquet(f"{tmp_path}/labels"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "doc_id" in plan and "SortMergeJoin" in plan and "Broadcast" not in plan
    assert sum(r["good"] for r in found.collect()) == 20 and "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
