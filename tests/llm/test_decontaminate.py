import random

import numpy as np
from helpers_llm import ALNUM, FOLD, edge_rows, frame, prose, table, texts_of

from daybook.llm import decontaminate as op


def words(text):
    return ALNUM.findall((text or "").translate(FOLD))


def brute_force(docs, items):
    number, out = {}, []

    def numbered(text):
        return np.array([number.setdefault(x, len(number)) for x in words(text)], np.int64)
    for i, text in docs:
        w, hit, weak = numbered(text), set(), set()
        for item, passage in items:
            b = numbered(passage)
            n = min(len(b), op.WINDOW)
            if not n:
                continue
            most = 0 if n < op.WINDOW else op.SUBSTITUTIONS
            if len(w) >= n:
                places = np.lib.stride_tricks.sliding_window_view(w, n)
                if any(((places != b[q:q + n]).sum(axis=1) <= most).any() for q in range(len(b) - n + 1)):
                    (hit if n >= op.MIN_WORDS else weak).add(item)
        named, short = (sorted(x - {None}) for x in (hit, weak))
        out.append((i, bool(hit), len(named), ",".join(map(str, named)), ",".join(map(str, short))))
    return sorted(out, key=repr)


def result(spark, docs, items):
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    out = op.decontaminate(docs, bench).select("doc_id", "contaminated", "n_items", "item_ids", "weak_item_ids").collect()
    return sorted(map(tuple, out), key=repr)


def test_every_window_with_few_substitutions_is_found(spark):
    rng = random.Random(2)
    items = [(k, prose(rng, rng.randint(6, 30))) for k in range(12)] + [(50, None), (51, ""), (None, prose(rng, 20)), (3, "x y")]
    rows = []
    for k in range(40):
        passage = rng.choice(items[:12])[1].split(" ")
        for _ in range(rng.randint(0, 5)):
            passage[rng.randrange(len(passage))] = "other"
        low = rng.randrange(3)
        rows.append((k, prose(rng, 10) + " " + ", ".join(passage[low:]) + " " + prose(rng, 10)))
    rows += edge_rows()
    want = brute_force(rows, items)
    assert result(spark, frame(spark, rows), items) == want
    assert {r[1] for r in want} == {True, False}


def test_short_items_are_weak_and_items_without_an_id_contaminate(spark):
    rng = random.Random(4)
    lost, whole = prose(rng, 20), prose(rng, 9)
    items = [(1, "only three words"), (2, "yes"), (None, "no id"), (None, lost), (5, whole), (6, lost)]
    rows = [(1, "these are only THREE words, yes"), (2, lost), (3, f"a {whole} b"), (4, "no id"), (5, "nothing"), (6, f"yes {lost} yes")]
    want = [(1, False, 0, "", "1,2"), (2, True, 1, "6", ""), (3, True, 1, "5", ""), (4, False, 0, "", ""),
            (5, False, 0, "", ""), (6, True, 1, "6", "2")]
    assert result(spark, frame(spark, rows), items) == brute_force(rows, items) == want
    items = items[:5]
    assert result(spark, frame(spark, rows), items)[1] == (2, True, 0, "", "")


def test_parts_of_the_benchmark_give_the_same(spark, monkeypatch):
    docs = table(spark, "documents")
    items = [tuple(r) for r in table(spark, "benchmark").select("item_id", "text").collect()]
    whole = result(spark, docs, items)
    assert whole == brute_force(texts_of(docs), items)
    monkeypatch.setattr(op, "PART_WINDOWS", 200)
    assert result(spark, docs, items) == whole
    bench = spark.createDataFrame(items, "item_id long, text string")
    plan = op.overlaps(docs, bench, carry=("lang",))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan           # the passes are over and written; no workers are chained
    rows = edge_rows() + [(None, items[0][1]), (40, items[1][1]), (40, items[1][1])]
    assert result(spark, frame(spark, rows), items) == brute_force(rows, items)


def test_empty_tables(spark):
    assert result(spark, frame(spark, []), [(1, prose(random.Random(1), 20))]) == []
    assert {r[1] for r in result(spark, frame(spark, edge_rows()), [])} == {False}
