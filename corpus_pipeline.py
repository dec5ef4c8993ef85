"""Corpus pipeline: quality classifier, quality rules, near duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and reread as the next one's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rowtide.llm import jaccard_join, packing, quality_model, quality_rules, secret_scan
from rowtide.llm.common import table
from rowtide.session import materialize

WORD_BPE = "word_bpe_49k.json"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts as good."""
    return quality_model.keep_good(docs, table(spark, sf_dir, "labels"))


def line_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by tags."""
    return secret_scan.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    return packing.pack_documents(docs, public_tokenizers.path(WORD_BPE))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", line_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("secret_scan", secrets),
    ("best_fit_packing", packing_stage),
]

ORACLE_SQL = None  # the classifier and the tokenizer can't be written in SQL; tests/llm hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
