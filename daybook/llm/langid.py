"""Operator 6: language of web pages by Bayesian evidence fusion.

Four pieces of evidence about a page are multiplied:

* text: a multinomial over hashed byte trigrams of the visible text per language,
  trained on a bounded sample of each language that any labelled document has, so
  rare languages are in it too, however many there are. Trigrams of one text are far
  from independent, so its log likelihood counts as at most ``TEXT_WEIGHT`` of them;
* declared markup language: how often each value is declared on pages of a language;
* address suffix: likewise for the language code in the path or the country suffix;
* host prior: the languages of the other pages of the host, smoothed towards its
  registered domain (three labels under a public suffix such as co.uk), and that towards the whole collection.

The last three are grouped sums of the pages' text-only posteriors (soft counts in
fixed point, so their sums do not depend on the order) over *all* pages. A page's
own share is taken out of its host's and domain's counts. A host of a third of all
pages is summed map-side and joined back by salted keys; the tables that reach the
driver have one row per language or language pair.

Edge cases: a page without any evidence (null url and html) gets the prior of the
collection. Labelled documents count whatever their id, null or repeated. Null or
empty html has no text, unknown languages and malformed markup count as 'none' or 'other'. Without labelled documents there are no languages and
``lang`` is null. Ties go to the alphabetically first language. Repeated rows are
each returned. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import html as markup
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm import textbytes as tb
from daybook.llm.common import cut

BUCKETS = 1 << 13
TRAIN_EACH = 1_000           # about so many labelled texts of each language, drawn by a hash; all of a rarer one
TEXT_WEIGHT = 60
MICRO = 1_000_000            # soft counts are whole millionths
SMOOTHING = 0.5
HOST_STRENGTH = 5.0          # pseudo-pages of the level above
SALTS = 16

_HIDDEN = re.compile(r"(?is)<(script|style|nav|footer|head)\b.*?(?:</\1\s*>|$)|<!--.*?(?:-->|$)|<[^>]*(?:>|$)")
_DECLARED = re.compile(r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]+)|<meta\b[^>]*content-language[\"']?[^>]*?content\s*=\s*[\"']?([a-z]+)")
_URL = re.compile(r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)(?::\d+)?(?:/([^/?#]*))?")
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


#: Fixed: labels under which country domains register names, as in example.co.uk.
SECOND_LEVEL = frozenset(
    "ac co com edu firm gen go gob gouv gov govt gv id ind info int ltd mil mod ne net nhs nic nom or org plc police re res sch school web".split())


def trigrams(text: str) -> np.ndarray:
    """The bucket of each byte trigram of a text, A-Z folded, runs of white space as one space."""
    data = _FOLD[np.frombuffer(" ".join(text.split()).encode("utf-8"), np.uint8)].astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64)
    packed = data[:-2] << np.uint32(16) | data[1:-1] << np.uint32(8) | data[2:]
    return ((packed * np.uint32(0x9E3779B1)) >> np.uint32(19)).astype(np.int64)


def registered_domain(host: str) -> str:
    """The name that an owner registers: one label before a public suffix, which has two labels in many countries."""
    labels = host.split(".")
    if host.replace(".", "").isdigit():
        return host                          # a network address has no domain above it
    two = len(labels) > 2 and len(labels[-1]) == 2 and labels[-2] in SECOND_LEVEL
    return ".".join(labels[-3 if two else -2:])


def visible_text(source: str) -> str:
    """What a reader sees of a page: no scripts, styles, comments, navigation, footer or tags."""
    return markup.unescape(_HIDDEN.sub(" ", source))


def training_texts(docs: DataFrame, most: int = TRAIN_EACH) -> DataFrame:
    """(text, language): about ``most`` labelled documents of each language, all where there are fewer.

    The languages and their counts come from all documents; a hash of id and text decides.
    """
    known = (docs.select("doc_id", "text", F.lower("lang").alias("language"))
             .where("language is not null and language <> ''"))
    sizes = known.groupBy("language").agg(F.count("*").alias("n"))          # one row per language
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    return known.join(F.broadcast(sizes), "language").where(share < F.lit(float(most)) / F.col("n")).select("text", "language")


def training_table(docs: DataFrame, most: int = TRAIN_EACH) -> tuple[list[str], np.ndarray]:
    """Languages, and fixed-point log probabilities (languages x buckets), from a bounded sample of each language."""
    texts = training_texts(docs, most)

    def run(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, language in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = counts.setdefault(language, np.zeros(BUCKETS, np.int64))
                own += np.bincount(trigrams(text or ""), minlength=BUCKETS)
        for language, n in counts.items():
            at = np.flatnonzero(n)
            yield pa.record_batch([pa.array([language] * len(at), pa.string()), pa.array(at), pa.array(n[at])],
                                  names=["language", "bucket", "n"])
    counted = (texts.select("text", "language").mapInArrow(run, "language string, bucket long, n long")
               .groupBy("language", "bucket").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(counted["language"].unique())
    table = np.full((len(languages), BUCKETS), SMOOTHING)
    for k, language in enumerate(languages):
        mine = counted[counted["language"] == language]
        table[k, mine["bucket"]] += mine["n"]
    return languages, np.rint(np.log(table / table.sum(axis=1, keepdims=True)) * 65536).astype(np.int64)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def evidence(pages: DataFrame, languages: list[str], table: np.ndarray) -> DataFrame:
    """(page_id, host, domain, declared, address, loglik, soft) of every page."""
    spark = pages.sparkSession
    shared = spark.sparkContext.broadcast(table)
    known = set(languages)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                rows = []
                for url, source in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    source = source or ""
                    hit = _URL.match(url or "")
                    host = hit.group(1).lower().rstrip(".") if hit else None
                    domain = registered_domain(host) if host else None
                    path = (hit.group(2) or "").lower() if hit else ""
                    suffix = host.rsplit(".", 1)[-1] if host else ""
                    address = path if path in known else suffix if suffix in known else "none"
                    said = _DECLARED.search(source)
                    declared = (said.group(1) or said.group(2)).lower() if said else "none"
                    if declared not in known and declared != "none":
                        declared = "other"
                    grams = trigrams(visible_text(source))
                    weight = min(len(grams), TEXT_WEIGHT) / max(len(grams), 1)
                    loglik = (shared.value[:, grams].sum(axis=1) if len(grams) < BUCKETS else
                              shared.value @ np.bincount(grams, minlength=BUCKETS)) / 65536 * weight
                    rows.append((host, domain, declared, address, loglik))
                logliks = np.array([r[4] for r in rows])
                soft = np.rint(_softmax(logliks) * MICRO).astype(np.int64)
                yield pa.record_batch([
                    part.column(0), *(pa.array([r[k] for r in rows], pa.string()) for k in range(4)),
                    pa.array(logliks.tolist(), pa.list_(pa.float64())), pa.array(soft.tolist(), pa.list_(pa.int64()))],
                    names=["page_id", "host", "domain", "declared", "address", "loglik", "soft"])
    kinds = ("page_id long, host string, domain string, declared string, address string, "
             "loglik array<double>, soft array<long>")
    return (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html")).mapInArrow(run, kinds))


def _summed(rows: DataFrame, keys: list[str], n: int, column: str, name: str) -> DataFrame:
    total = rows.groupBy(*keys).agg(*(F.sum(F.col(column)[k]).alias(f"_{k}") for k in range(n)))
    return total.select(*keys, F.array(*(f"_{k}" for k in range(n))).alias(name))


def _conditional(rows: DataFrame, column: str, values: list[str], n: int) -> np.ndarray:
    """log P(value | language) for each value (rows) and language (columns), smoothed."""
    counts = np.full((len(values), n), SMOOTHING)
    for r in _summed(rows, [column], n, "soft", "total").collect():        # one row per value
        counts[values.index(r[column])] += np.array(r["total"]) / MICRO
    return np.log(counts / counts.sum(axis=0, keepdims=True))


def page_languages(pages: DataFrame, labelled: DataFrame) -> DataFrame:
    """(page_id, host, declared, address, lang, confidence, text_lang) of every page."""
    languages, table = training_table(labelled)
    n = len(languages)
    schema = ("page_id long, host string, declared string, address string, lang string, confidence double, "
              "text_lang string")
    if not n:
        none = F.lit(None).cast("string")
        return pages.select(F.col("page_id").cast("long").alias("page_id"), none.alias("host"), none.alias("declared"),
                            none.alias("address"), none.alias("lang"), F.lit(None).cast("double").alias("confidence"),
                            none.alias("text_lang"))
    rows = cut(evidence(pages, languages, table))
    hosts = _summed(rows.where("host is not null"), ["domain", "host"], n, "soft", "in_host")
    hosts = cut(hosts)
    domains = cut(_summed(hosts, ["domain"], n, "in_host", "in_domain"))
    whole = [r["total"] for r in _summed(rows.withColumn("all", F.lit(0)), ["all"], n, "soft", "total").collect()]
    overall = (np.array(whole[0], float) / MICRO if whole else np.zeros(n)) + SMOOTHING
    overall /= overall.sum()
    declared_values, address_values = [*languages, "none", "other"], [*languages, "none"]
    declared = _conditional(rows, "declared", declared_values, n)
    address = _conditional(rows, "address", address_values, n)

    levels = hosts.join(domains, "domain").select("host", "in_host", "in_domain").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    joined = salted.join(levels, ["host", "salt"], "left").select(
        "page_id", "host", "declared", "address", "loglik", "soft", "in_host", "in_domain")

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            get = lambda k: np.array([x if x is not None else [0] * n for x in batch.column(k).to_pylist()], float)
            loglik, soft, in_host, in_domain = (get(k) for k in (4, 5, 6, 7))
            counted = np.asarray(batch.column(6).is_valid())[:, None]
            in_host, in_domain = ((x - soft * counted) / MICRO for x in (in_host, in_domain))
            prior = (in_domain + HOST_STRENGTH * overall) / (in_domain.sum(axis=1, keepdims=True) + HOST_STRENGTH)
            prior = (in_host + HOST_STRENGTH * prior) / (in_host.sum(axis=1, keepdims=True) + HOST_STRENGTH)
            total = np.log(prior) + loglik
            total += declared[[declared_values.index(x) for x in batch.column(2).to_pylist()]]
            total += address[[address_values.index(x) for x in batch.column(3).to_pylist()]]
            posterior = _softmax(total)
            best = posterior.argmax(axis=1)
            text_best = loglik.argmax(axis=1)
            yield pa.record_batch([
                *(batch.column(k) for k in range(4)), pa.array([languages[k] for k in best], pa.string()),
                pa.array(np.round(posterior.max(axis=1), 6)), pa.array([languages[k] for k in text_best], pa.string())],
                names=["page_id", "host", "declared", "address", "lang", "confidence", "text_lang"])
    return joined.mapInArrow(run, schema)
