import hashlib
import random

import public_tokenizers
import pytest
from helpers_llm import SF, edge_rows, frame, texts_of
from tokenizers import Tokenizer

from daybook.llm import bpe, queries, tokencount

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
PIECES = ["a", "b", "'s", "'", "Σ", "ς", "İ", "é", "é", " ", "\t", "\n", "\x1c", "\x85", "​",
          "²", "½", "ª", "µ", "\xa0", "ÿ", "<|endoftext|>", "<|startoftext|>", "1", "२", "中", "😀", "!!", "<|", "ſ", "ß", "　", "ﬁ", " ", "the"]


@pytest.mark.parametrize("name", FILES)
def test_random_texts_equal_the_library(name):
    path = public_tokenizers.path(name)
    library, codec, rng = Tokenizer.from_file(path), bpe.codec(path), random.Random(5)
    for _ in range(1500):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30)))
        pre = codec.pre_tokens(text)
        words = codec.encode_words([w for w in pre if not isinstance(w, int)])
        ids = []
        for w in pre:
            ids += [w] if isinstance(w, int) else words.pop(0)
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == want
        assert codec.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_encode_and_decode_queries_equal_the_library(spark):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = texts_of(spark.read.parquet(f"{SF}/documents.parquet"))
    want = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, queries.op4_bpe(spark, SF).collect())) == sorted(want)


def test_edge_rows_round_trip(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [*edge_rows(), (20, "<|endoftext|> x <|endoftext|>"), (21, "é\x00  \n\n tail ")]
    out = bpe.decode(bpe.encode(frame(spark, rows), path), path).select("doc_id", "decoded").collect()
    assert sorted(map(tuple, out), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)
    assert bpe.decode(bpe.encode(frame(spark, []), path), path).collect() == []


@pytest.mark.parametrize("name", FILES)
def test_one_pass_equals_encode_then_decode(spark, name):
    path = public_tokenizers.path(name)
    for rows in ([*edge_rows(), (20, "<|endoftext|> x <|endoftext|>"), (21, "é\x00  \n\n tail ")], []):
        docs = frame(spark, rows)
        one, two = bpe.encode_and_decode(docs, path), bpe.decode(bpe.encode(docs, path), path)
        assert one.schema == two.schema
        assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, two.collect()), key=repr)


def test_token_counts_equal_the_library(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = [*edge_rows(), (20, "<|endoftext|> x <|endoftext|>")]
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 1024)
            for i, t in rows]
    got = [tuple(r) for r in tokencount.token_counts(frame(spark, rows), path).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert tokencount.token_counts(frame(spark, []), path).collect() == []


def test_the_frequent_table_never_changes_a_count(spark, monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    full = sorted(map(tuple, tokencount.token_counts(docs, path).collect()))
    monkeypatch.setattr(tokencount, "frequent_words", lambda *a, **k: ["the"])
    assert sorted(map(tuple, tokencount.token_counts(docs, path).collect())) == full


def test_a_vocabulary_with_late_parts_is_refused(tmp_path):
    import json
    spec = json.load(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8"))
    spec["model"]["merges"] = spec["model"]["merges"][::-1]
    (tmp_path / "v.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="merge comes before"):
        bpe.Codec(str(tmp_path / "v.json"))
