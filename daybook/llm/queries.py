"""The registered queries ``opN_<name>``: each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import (
    bpe, bwtdedup, covertree, decontaminate, filteraudit, hyperminhash, langid, licenses, linetemplates, pii,
    projections, quality, tokencount)
from daybook.llm.common import documents

#: Names of the public vocabulary files; the library resolves their place on each machine.
WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"
#: The session setting that holds the key of the surrogates.
PII_KEY = "spark.daybook.pii.key"


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(documents(spark, sf_dir))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op3_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped and the digest of the text that stays."""
    out = linetemplates.line_dedup(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(WORD_BPE)
    return bpe.digests(bpe.decode(bpe.encode(documents(spark, sf_dir), path), path))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE))


def op6_page_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.page_languages(documents(spark, sf_dir, "pages"), documents(spark, sf_dir))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymised(documents(spark, sf_dir), key=spark.conf.get(PII_KEY, pii.KEY))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_labels(licenses.license_scan(documents(spark, sf_dir)))


def op10_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest columns, and the remaining text (a character that a removed span cuts shows as U+FFFD)."""
    out = bwtdedup.without_repeats(documents(spark, sf_dir))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
                      F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op12_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.near_vectors(documents(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of every seventh row are moved on, components are scaled to whole numbers, every hundredth row asks."""
    vec_id, label = F.col("vec_id"), F.col("label")

    def scaled(x: Column) -> Column:
        y = x.cast("double") * 256
        return F.when(F.abs(y) < 2.0 ** 52, F.floor(y).cast("double")).otherwise(y)   # beyond, y is whole or not finite

    rows = documents(spark, sf_dir, "embeddings").select(
        "vec_id", F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.transform("embedding", scaled).alias("embedding"))
    return covertree.hard_negatives(rows, vec_id % 100 == 0)


def quality_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``op2_quality`` that its base rules define."""
    return op2_quality(spark, sf_dir).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def license_base_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``op9_license_scan`` that its base phrases define."""
    return op9_license_scan(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


QUERIES = {f.__name__: f for f in (
    op1_near_duplicates, op2_quality, op3_line_templates, op4_bpe, op5_token_counts,
    op6_page_languages, op7_decontaminate, op8_pii_surrogates, op9_license_scan, op10_repeated_strings,
    op11_filter_audit, op12_near_vectors, op13_hard_negatives, quality_base_counts, license_base_places)}
