import math

from helpers_llm import SF

from daybook.llm import langid as op

SF01 = "/root/testdata/sf0.01"


def truth(spark, sf):
    """doc_id stands in the address of a page; its language is the document's."""
    pages, docs = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("pages", "documents"))
    found = pages.selectExpr("page_id", "cast(regexp_extract(url, '/([0-9]+)([.?#/]|$)', 1) as long) doc_id")
    return pages, docs, dict(found.join(docs, "doc_id").select("page_id", "lang").collect())


def test_held_out_accuracy(spark):
    pages, docs, lang = truth(spark, SF01)
    held = op.page_languages(pages, docs.where("doc_id % 2 = 0")).collect()
    known = [r for r in held if r["page_id"] in lang]
    assert len(held) == pages.count() and len(known) > 100
    assert sum(r["lang"] == lang[r["page_id"]] for r in known) >= 0.98 * len(known)


def test_evidence_matters_where_text_is_missing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    german = docs.where("lang = 'de'").limit(12).collect()
    rows = [(k, "http://news.example.org/x", f"<html><body>{r['text'][:600]}</body></html>", "clash") for k, r in enumerate(german)]
    rows += [(100, "http://news.example.org/y", "<html lang='de'></html>", "c"), (101, "http://www.example.de/", "", "c"),
             (102, None, None, None), (102, None, None, None), (103, "not an address", "<p", "c"),
             (104, "http://news.example.org/z", None, "c"), (None, "http://a.b/de/1", "<html lang=\"de-DE\">", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {}
    for r in op.page_languages(pages, docs).collect():
        got.setdefault(r["page_id"], []).append(r)
    assert len(got[102]) == 2 and got[102][0] == got[102][1]
    assert got[100][0]["lang"] == got[104][0]["lang"] == "de" and got[None][0]["declared"] == "de"
    assert got[101][0]["address"] == "de" and got[103][0]["host"] is None
    assert all(0 < r["confidence"] <= 1 for x in got.values() for r in x)


def test_more_than_64_languages_and_a_rare_one(spark):
    """Seventy languages of two documents beside one of 6,000: all are known, and the large one is sampled."""
    code = lambda k: "q" + chr(97 + k // 26) + chr(97 + k % 26)
    words = lambda k: " ".join(f"{chr(0x4E00 + 40 * k + j)}{chr(0x4E07 + 40 * k + j)}" for j in range(30))
    rows = [(2 * k + j, words(k), code(k)) for k in range(70) for j in range(2)]
    rows += [(1000 + k, f"the common words of text {k}", "en") for k in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sampled = dict(op.training_texts(docs).groupBy("language").count().collect())
    assert len(sampled) == 71 and 800 < sampled.pop("en") < 1200 and set(sampled.values()) == {2}
    pages = spark.createDataFrame([(k, f"http://a{k}.example.org/{code(k)}/x", f"<html lang='{code(k)}'><p>{words(k)}</p></html>")
                                   for k in range(70)], "page_id long, url string, html string")
    for r in op.page_languages(pages, docs).collect():
        assert r["lang"] == r["declared"] == r["address"] == r["text_lang"] == code(r["page_id"])


def test_registered_domains():
    names = {"www.example.com": "example.com", "a.b.example.co.uk": "example.co.uk", "example.co.uk": "example.co.uk", "co.uk": "co.uk",
             "x.example.com.au": "example.com.au", "news.example.de": "example.de", "localhost": "localhost", "10.0.0.1": "10.0.0.1",
             "blog.net.example.org": "example.org", "a.gov.br": "a.gov.br", "x.y.co.jp": "y.co.jp", "co.example.io": "example.io"}
    assert {h: op.registered_domain(h) for h in names} == names


def test_hosts_under_one_public_suffix_are_unrelated(spark):
    """A page without evidence follows its own domain, not the many pages of another one under the same suffix."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r["lang"]: r["text"][:600] for r in docs.where("lang in ('de', 'fr')").collect()}
    rows = [(k, f"http://h{k}.deutsch.co.uk/x", text["de"]) for k in range(40)]
    rows += [(100 + k, f"http://h{k}.francais.co.uk/x", text["fr"]) for k in range(12)] + [(200, "http://new.francais.co.uk/", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["page_id"]: r["lang"] for r in op.page_languages(pages, docs).collect()}[200] == "fr"


def test_documents_without_an_id_are_training_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    nameless = docs.selectExpr("CAST(NULL AS LONG) AS doc_id", "text", "lang")
    assert op.training_texts(nameless).count() == docs.count()


def test_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    assert op.page_languages(pages.where("false"), docs).collect() == []
    none = op.page_languages(pages, docs.where("false")).collect()
    assert len(none) == pages.count() and {r["lang"] for r in none} == {None}


def test_fusion_matches_a_plain_version(spark):
    """Priors, declared and address evidence and the posterior, recomputed by loops from the pages' text evidence."""
    pages, docs, _ = truth(spark, SF)
    languages, table = op.training_table(docs)
    rows = [r.asDict() for r in op.evidence(pages, languages, table).collect()]
    n = len(languages)
    total = [sum(r["soft"][k] for r in rows) / op.MICRO + op.SMOOTHING for k in range(n)]
    overall = [x / sum(total) for x in total]

    def conditional(column, values):
        c = {v: [op.SMOOTHING + sum(r["soft"][k] for r in rows if r[column] == v) / op.MICRO for k in range(n)] for v in values}
        return {v: [math.log(c[v][k] / sum(c[w][k] for w in values)) for k in range(n)] for v in values}
    declared, address = conditional("declared", [*languages, "none", "other"]), conditional("address", [*languages, "none"])
    want = {}
    for r in rows:
        level = overall
        for key in ("domain", "host"):
            others = [q for q in rows if q["page_id"] != r["page_id"] and q[key] == r[key] and r[key] is not None]
            c = [sum(q["soft"][k] for q in others) / op.MICRO for k in range(n)]
            level = [(c[k] + op.HOST_STRENGTH * level[k]) / (sum(c) + op.HOST_STRENGTH) for k in range(n)]
        score = [math.log(level[k]) + r["loglik"][k] + declared[r["declared"]][k] + address[r["address"]][k] for k in range(n)]
        top = max(score)
        share = [math.exp(s - top) for s in score]
        want[r["page_id"]] = (languages[score.index(top)], max(share) / sum(share))
    for r in op.page_languages(pages, docs).collect():
        lang, confidence = want[r["page_id"]]
        assert r["lang"] == lang and abs(r["confidence"] - confidence) < 1e-3
