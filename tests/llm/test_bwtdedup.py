import collections
import hashlib
import random

import numpy as np
import pytest
from helpers_llm import edge_rows, frame, prose, table, texts_of

from daybook.llm import bwtdedup as op


def brute_force(rows):
    texts = [(i, (t or "").encode("utf-8")) for i, t in rows]
    count = collections.Counter(raw[k:k + op.LENGTH] for _, raw in texts for k in range(len(raw) - op.LENGTH + 1))
    out = []
    for i, raw in texts:
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - op.LENGTH + 1):
            if count[raw[k:k + op.LENGTH]] > 1:
                gone[k:k + op.LENGTH] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone]) if raw else b""
        spans = int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum())
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(docs):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest())
                   for r in op.without_repeats(docs).collect()), key=repr)


def passages(rng):
    shared = [prose(rng, n) for n in (60, 70, 110)] + ["ab" * 300]
    rows = []
    for k in range(25):
        parts = [prose(rng, rng.randint(0, 90))]
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(shared)
            low = rng.randrange(20)
            parts += [passage[low:], prose(rng, rng.randint(0, 30))]
        rows.append((k, " ".join(parts)))
    return rows


@pytest.mark.parametrize("wide", [2000, 1])
def test_shared_passages_match_brute_force(spark, monkeypatch, wide):
    monkeypatch.setattr(op, "WIDE_CLASS", wide)
    rows = passages(random.Random(4)) + edge_rows()
    assert result(frame(spark, rows)) == brute_force(rows)


@pytest.mark.parametrize("by_bytes", [False, True])
def test_a_passage_that_goes_on_differently_is_not_solved_whole(spark, monkeypatch, by_bytes):
    """Pieces at the edges of one passage share their name; none of more than WIDE_ROUTE reaches one solve."""
    rng = random.Random(6)
    passage = prose(rng, 200)[:450]
    rows = [(k, f"{prose(rng, 12)} {passage}{prose(rng, 12)}") for k in range(40)] + [(90, "ab" * 400), (91, "x" + "ab" * 300)]
    monkeypatch.setattr(op, "WIDE_BYTES" if by_bytes else "WIDE_CLASS", 1)
    monkeypatch.setattr(op, "WIDE_ROUTE", 5)
    whole, seen = op.compared, []

    def watched(contents):
        seen.append(max([r["count"] for r in contents.groupBy("route").count().collect()], default=0))
        return whole(contents)
    monkeypatch.setattr(op, "compared", watched)
    assert result(frame(spark, rows)) == brute_force(rows)
    assert seen and max(seen) <= 5


def test_smallest_table_matches_brute_force(spark):
    docs = table(spark, "documents")
    assert result(docs) == brute_force(texts_of(docs))


def test_empty_table(spark):
    assert result(frame(spark, [])) == []


def test_slices_and_shards_do_not_change_the_result(monkeypatch):
    rng = random.Random(9)
    strings = [t.encode() for _, t in passages(rng) if len(t.encode()) >= op.LENGTH]
    whole = op.repeated_windows(strings)
    monkeypatch.setattr(op, "SHARD_BYTES", 600)
    for a, b in zip(whole, op.repeated_windows(strings), strict=True):
        assert (a == b).all()
    count = collections.Counter(s[k:k + op.LENGTH] for s in strings for k in range(len(s) - op.LENGTH + 1))
    for s, flags in zip(strings, whole, strict=True):
        assert [count[s[k:k + op.LENGTH]] > 1 for k in range(len(s) - op.LENGTH + 1)] == flags.tolist()
