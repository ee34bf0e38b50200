"""The corpus pipeline: from documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's docs. All but the last return the columns of documents.
A stage's tables other than docs (labels, benchmark) are read from sf_dir.

Defined results: documents may have further columns of any names, which all stages but the
last keep as they are. A null or empty text has no words, so the classifier rejects it. A
null lang is judged by the threshold over all languages. Rows that repeat a doc_id are
judged as one document by the classifier and each by itself by the rules; of repeats of one
row the near-dedup keeps one. Rows with a null doc_id are never near duplicates of others.
Without trusted labels the classifier keeps every document with words; without benchmark
items nothing is contaminated. No documents give no sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayframe.llm import decontaminate, kneser_ney, neardup, packing, quality_rules
from wayframe.llm.frames import table
from wayframe.sources.scratch import settle


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is usual for trusted text of their language."""
    return kneser_ney.keep_good(docs, table(spark, sf_dir, "labels"))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighted rules hold for good."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, over shingles of five words."""
    return neardup.keep_one(docs, words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and the place in it."""
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", rules),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

# Expectation-maximisation, a trained model and a tokenizer are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
