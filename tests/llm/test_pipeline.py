import hashlib

import corpus_pipeline
import public_tokenizers
import test_decontaminate
import test_hyperminhash
import test_linetemplates
import test_quality
from helpers_llm import SF, table, texts_of
from tokenizers import Tokenizer

import __spark_entry__
from daybook.llm import linetemplates


def test_pipeline_matches_the_brute_force_stages(spark):
    """run() against plain versions of all five stages, each over what the one before kept."""
    rows = texts_of(table(spark, "documents"))
    labels = [tuple(r) for r in table(spark, "labels").select("doc_id", "quality", "toxic").collect()]
    items = [tuple(r) for r in table(spark, "benchmark").select("item_id", "text").collect()]
    good = {r[0] for r in test_quality.brute_force(rows, labels) if r[7]}
    rows = [r for r in rows if r[0] in good]
    rows = test_linetemplates.brute_force(rows, linetemplates.MIN_DOCS)
    kept = {r[0] for r in test_hyperminhash.brute_force(rows) if r[3]}
    rows = [r for r in rows if r[0] in kept]
    clean = {r[0] for r in test_decontaminate.brute_force(rows, items) if not r[1]}
    rows = [r for r in rows if r[0] in clean]
    library, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), []
    for i, text in rows:
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), " ".join(map(str, ids)), hashlib.sha256(decoded.encode()).hexdigest()))
    assert 50 < len(want) < 200
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(want)


def test_stages_return_the_columns_of_documents(spark):
    docs = table(spark, "documents")
    for _, stage in (corpus_pipeline.STAGES[0], corpus_pipeline.STAGES[3]):
        assert stage(spark, docs, SF).dtypes == docs.dtypes


def test_bpe_encoding_takes_one_python_worker_a_task(spark):
    """Each Python step of a plan keeps a worker and a vocabulary of its own in memory for every task."""
    plan = corpus_pipeline.bpe_encoding(spark, table(spark, "documents"), SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_registered_queries():
    names = [q for q in __spark_entry__.queries() if q.startswith("op")]
    assert [int(q[2:].split("_")[0]) for q in names] == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()
