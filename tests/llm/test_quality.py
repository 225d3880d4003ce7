import collections
import math

import numpy as np
from helpers_llm import WORDS, edge_rows, frame, table, texts_of

from daybook.llm import quality as op


def base(text):
    text = text or ""
    words, seen, dup = WORDS.findall(text), set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    windows = collections.Counter(zip(words, words[1:], words[2:], strict=False))
    marked = {k + j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(3)}
    failed = len(words) < 50 or 100 * len(marked) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(marked), failed)


def buckets(text):
    raw = (text or "").encode("utf-8")
    return [(int.from_bytes(raw[k:k + op.NGRAM], "big") * 0x9E3779B1 & 0xFFFFFFFF) >> 16
            for k in range(len(raw) - op.NGRAM + 1)]


def brute_force(rows, labels):
    """Rows of the result: base counts, verdict and score, by plain loops."""
    worst = {}
    for i, q, t in labels:
        if i is not None and q is not None:
            a, b = worst.get(i, (1, 0))
            worst[i] = (min(a, q), max(b, t or 0))
    good = {i: v == (1, 0) for i, v in worst.items()}
    raw, target = collections.Counter(), collections.Counter()
    for i, t in rows:
        raw.update(buckets(t))
        if good.get(i):
            target.update(buckets(t))
    n_raw, n_target = sum(raw.values()), sum(target.values())
    ratio = {b: round(math.log(((target[b] + .5) / (n_target + .5 * op.BUCKETS))
                               / ((raw[b] + .5) / (n_raw + .5 * op.BUCKETS))) * op.FIXED_POINT) for b in raw}
    score = [sum(ratio[b] for b in g) / len(g) if (g := buckets(t)) else None for _, t in rows]
    counts = [base(t) for _, t in rows]
    if not n_target:
        return [(i, *c, not c[-1], None) for (i, _), c in zip(rows, counts, strict=True)]
    known = [(s, good[i]) for (i, _), s, c in zip(rows, score, counts, strict=True)
             if i in good and s is not None and not c[-1]]
    cut = -math.inf
    if known:
        cut = op.fit_threshold(np.array([s for s, _ in known]), np.array([g for _, g in known]))
    return [(i, *c, not c[-1] and s is not None and s >= cut, None if s is None else s / op.FIXED_POINT)
            for (i, _), c, s in zip(rows, counts, score, strict=True)]


def same(got, want):
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=repr), sorted(want, key=repr), strict=True):
        assert a[:8] == b[:8] and (a[8] is None) == (b[8] is None)
        assert a[8] is None or abs(a[8] - b[8]) < 1e-9


def result(docs, labels):
    return [tuple(r) for r in op.quality(docs, labels).collect()]


def test_smallest_table_matches_brute_force(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    rows = [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()]
    same(result(docs, labels), brute_force(texts_of(docs), rows))


def test_edge_rows_and_labels(spark):
    labels = [(1, 1, 0), (1, 1, 0), (9, 1, 0), (9, 0, 0), (3, 1, 1), (None, 1, 0), (4, None, 0), (5, 1, 0), (77, 1, 0)]
    frame_of = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    same(result(frame(spark, edge_rows()), frame_of), brute_force(edge_rows(), labels))
    none = frame_of.where("false")
    same(result(frame(spark, edge_rows()), none), brute_force(edge_rows(), []))
    assert result(frame(spark, []), frame_of) == []


def test_carried_columns_keep_their_rows(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    out = op.quality(docs, labels, carry=("lang", "source")).select("doc_id", "text", "rest.*").collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, docs.select("doc_id", "text", "lang", "source").collect()))


def test_threshold_prefers_the_widest_gap():
    score = np.array([-5.0, -4.0, 1.0, 1.5, 2.0])
    assert op.fit_threshold(score, np.array([False, False, True, True, True])) == -1.5


def test_clean_documents_stay_and_junk_goes(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    judged = op.quality(docs, labels).where("not base_failed").join(labels, "doc_id")
    rows = judged.groupBy("quality", "toxic").agg({"*": "count", "kept": "max"}).collect()
    assert {r["max(kept)"] for r in rows if r["quality"] == 0} == {False}
    clean = judged.where("quality = 1 and toxic = 0")
    assert clean.where("kept").count() >= 0.99 * clean.count()
