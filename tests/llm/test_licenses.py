import random
import re
import time

from helpers_llm import ALNUM, FOLD, edge_rows, frame, table, texts_of

from daybook.llm import licenses as op


def base(text):
    w = ALNUM.findall((text or "").translate(FOLD))
    places = [(k, label) for phrase, label in op.BASE_PHRASES.items() for k in range(len(w))
              if w[k:k + len(phrase.split())] == phrase.split()]
    at = [k for k, _ in places]
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))


def labels(text):
    """Labels by plain regular expressions, without a gate, with suppression by containment."""
    flat = " ".join(ALNUM.findall((text or "").translate(FOLD)))
    found = []
    for r in op.RULES:
        for m in re.finditer(f"(?<![^ ])(?:{r.pattern})(?![^ ])", flat):
            found.append((m.start(), m.end(), r.priority, r.label))
    left = {d[3] for d in found if not any(e[2] > d[2] and e[0] <= d[0] and e[1] >= d[1] for e in found)}
    return ",".join(sorted(left | set(filter(None, base(text)[4].split(",")))))


SAMPLES = [
    "CC by, cc-by; (CC)(BY) 4.0 cc by", "Licensed under CC BY-NC 4.0.", "GNU General Public License, version 2 or later",
    "All rights\nreserved. all rights. reserved ALL RIGHTS RESERVED", "SPDX-License-Identifier: GPL-3.0-only",
    "the Apache License, Version 2.0 http://www.apache.org/licenses/LICENSE-2.0", "MIT License. Copyright (c) 2020-2024",
    "accby cc byte occ by", "Licensed under the GNU Affero General Public License v3", "BSD 3-Clause License, 2-clause BSD",
    "éall rights reserved", "gpl" * 5, "https://creativecommons.org/licenses/by-sa/4.0/", "cc by " * 500,
]


def test_rules_are_many_and_carry_their_keywords():
    assert len(op.RULES) > 300
    for r in op.RULES:
        assert r.keyword in r.pattern.replace("(?:", "").replace("licen[sc]e", "license"), r


def test_samples_and_edge_rows_match_brute_force(spark):
    rows = [*enumerate(SAMPLES, 100), *edge_rows()]
    got = op.license_labels(op.license_scan(frame(spark, rows))).collect()
    want = sorted(((i, *base(t), labels(t)) for i, t in rows), key=repr)
    assert sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"])
                   for r in got), key=repr) == want
    assert all(0 <= r["score"] <= 1 and (r["score"] > 0) == (r["labels"] != "") for r in got)
    assert op.license_labels(op.license_scan(frame(spark, []))).collect() == []


def test_smallest_table_matches_brute_force(spark):
    docs = table(spark, "documents")
    got = op.license_labels(op.license_scan(docs)).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((i, *base(t), labels(t)) for i, t in texts_of(docs)), key=repr)


def test_many_overlapping_matches_match_brute_force(spark):
    """Blocks of the sweep: thousands of matches, nested, adjoining and of equal extent, across block borders."""
    rng = random.Random(2)
    pieces = ["licensed under the mit license", "mit license", "cc by 4.0", "apache license version 2.0", "gnu general public license v3 or later",
              "spdx-license-identifier: mit", "copyright (c) 2020-2024", "see the license file for details", "public domain", "word",
              "licensed under the terms of the", "bsd 3-clause license", "all rights reserved"]
    rows = [(k, " ".join(rng.choice(pieces) for _ in range(n))) for k, n in enumerate((3, 40, 300, 1200))]
    got = op.license_labels(op.license_scan(frame(spark, rows))).collect()
    assert sorted((r["doc_id"], r["n_base"], r["labels"]) for r in got) == [(i, base(t)[1], labels(t)) for i, t in rows]
    found = {r["doc_id"]: r["found"] for r in op.license_scan(frame(spark, rows)).collect()}
    for i, text in rows[:3]:
        flat = " ".join(ALNUM.findall(text.translate(FOLD)))
        every = [(r.priority, flat[:m.start()].count(" "), flat[:m.end()].count(" ") + 1, r.label) for r in op.RULES
                 for m in re.finditer(f"(?<![^ ])(?:{r.pattern})(?![^ ])", flat)]
        want = [d for d in every if not any(e[0] > d[0] and e[1] <= d[1] and e[2] >= d[2] for e in every)]
        assert sorted((d["priority"], d["start"], d["stop"], d["label"]) for d in found[i]) == sorted(want)


def test_time_is_linear_in_one_text(spark):
    """Matches everywhere in one text: eight times the text takes about eight times as long, not sixty-four."""
    def seconds(n):
        df = frame(spark, [(1, "cc by 4.0 and the mit license " * n)])
        best = []
        for _ in range(2):
            began = time.monotonic()
            (row,) = op.license_labels(op.license_scan(df)).collect()
            best.append(time.monotonic() - began)
            assert row["n_base"] == n and row["n_words"] == 8 * n
        return min(best)
    idle = seconds(1)
    assert seconds(24_000) - idle < 16 * max(seconds(3_000) - idle, 0.5)


def test_no_python_in_the_plan(spark):
    plan = op.license_labels(op.license_scan(table(spark, "documents")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
