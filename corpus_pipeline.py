"""A corpus made ready for training: five stages, each over all that the one before has kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written and read again for the next
stage. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltmark.llm import bpe, decontaminate, line_dedup, near_dedup, quality
from voltmark.llm.scratch import Scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the quality classifier accepts; it learns from the labelled ones of ``docs``."""
    model = quality.trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _columns(quality.scored(_columns(docs), model, threshold=0.3).where("predicted = 1"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that many documents repeat; ``n_chars`` follows the text. A null text becomes an empty one."""
    return _columns(line_dedup.deduplicated(_columns(docs)).withColumn("n_chars", F.length("text").cast("long")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: the one with the smallest id."""
    keep = near_dedup.near_duplicates(docs, shingle=5, similarity=0.8).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    kept = _columns(docs).join(keep, "doc_id", "left_semi")
    return kept.unionByName(_columns(docs).where("doc_id IS NULL"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold ten consecutive words of a benchmark item."""
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)
    dirty = found.where("contaminated").select("doc_id").distinct()
    return _columns(docs).join(dirty, "doc_id", "left_anti")


def tokenisation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with hashes of them and of what they decode to."""
    return bpe.encoded(docs, public_tokenizers.path("word_bpe_49k.json"), ids=True, digests=True)


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", line_dedup_stage),
    ("near dedup", near_dedup_stage),
    ("decontamination", decontamination),
    ("tokenisation", tokenisation),
]

#: A trained classifier and a tokenizer are beyond SQL; ``tests/llm`` holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what is in between is written to the shared folder."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = scratch.store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
