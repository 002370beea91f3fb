"""The registered queries of this package: one for each operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltmark.llm import bpe, decontaminate, embedding_dedup, html_text, language, license_scan, line_dedup, near_dedup, pii, quality, source_audit, substring_dedup, whitening


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.deduplicated(docs, window=13, text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.deduplicated(docs, text=False).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encoded(table(spark, sf_dir, "documents"), path, ids=False, digests=True)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.personal_data(docs, pii.trained(docs), keep_text=False)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extracted(pages, html_text.trained(pages), keep_html=False)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.trained(docs)
    held = docs.select("doc_id", "text").withColumn("held_out", F.coalesce(language.held_out("doc_id"), F.lit(False)))
    return language.identified(held, model, keep_text=False).select("doc_id", "held_out", "lang_pred", "score")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, similarity=0.8)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.trained(docs, table(spark, sf_dir, "labels"))
    held = docs.withColumn("held_out", F.coalesce(quality.held_out("doc_id"), F.lit(False)))
    return quality.scored(held, model, threshold=0.3, keep_text=False).select("doc_id", "held_out", "score", "predicted")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.divergence(table(spark, sf_dir, "documents"), min_docs=3, top=200)


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.scanned(docs, keep_text=False).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"), components=32)


QUERIES = {f.__name__: f for f in (op1_embedding_dedup, op2_bpe, op3_pii, op4_decontaminate, op5_html_text, op6_language, op7_near_dedup, op8_substring_dedup, op9_line_dedup, op10_quality, op11_source_divergence, op12_licenses, op13_whitening)}
