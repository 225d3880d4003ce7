"""Fixtures of the operator tests: documents with edge cases, and a reader of the small tables."""

from __future__ import annotations

import random
import re

SF = "/root/testdata/sf0.001"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: ``text_`` and ``rep`` clash with nothing an operator returns, ``items``, ``registers`` and ``k1`` with inner names
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, items string, registers long, k1 string"


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdeéß中") for _ in range(rng.randint(2, 7))) for _ in range(n))


def edge_rows() -> list[tuple]:
    """(doc_id, text): null and empty texts, null ids, repeated rows, white space, one word, a very long text."""
    rng = random.Random(7)
    base = prose(rng, 120)
    near = base.split(" ")
    near[60] = "changed"
    long_text = "\n".join(prose(rng, 60) for _ in range(120))
    return [
        (1, base), (2, base), (2, base), (3, " ".join(near)), (4, ""), (5, None), (6, " \t\n "), (7, "word"),
        (8, "word"), (None, base), (None, None), (9, long_text), (10, long_text + "\n" + base),
        (11, "a " * 3000), (12, "x" * 5000), (13, base.upper()),
    ]


def frame(spark, rows: list[tuple]):
    return spark.createDataFrame([(i, t, "en", "s", 1, "clash", 5, "k") for i, t in rows], SCHEMA)


def table(spark, name: str):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def texts_of(docs) -> list[tuple]:
    return [tuple(r) for r in docs.select("doc_id", "text").collect()]


def stage_tasks(spark, run, partitions: int = 64) -> list[int]:
    """The tasks of each stage that ``run`` starts while every shuffle has that many partitions and Spark joins none of them."""
    sc, conf = spark.sparkContext, {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    group = f"stage-tasks-{random.random()}"
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        sc.setJobGroup(group, group)
        run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in old.items():
            spark.conf.set(k, v)
    tracker = sc.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
    stages = {s: tracker.getStageInfo(s) for j in jobs if j for s in j.stageIds}
    return [s.numCompletedTasks for s in stages.values() if s and s.numCompletedTasks]
