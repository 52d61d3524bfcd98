"""The corpus pipeline: toxicity, exact dedup, near dedup, decontamination and packing.

Each stage calls one operator of ``lexitrend.llm`` on all documents its predecessor kept; what a
stage decides takes effect (rejected documents and surplus copies go). A stage's result is
written as Parquet to the shared folder and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexitrend.llm import op1_near_dedup, op2_toxicity, op5_decontaminate, op6_packing, op7_exact_dedup
from lexitrend.llm.catalog import tokenizer
from lexitrend.llm.common import staged, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go; the model learns from the labelled ones."""
    return op2_toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays: the one with the largest id."""
    return op7_exact_dedup.keep_rows(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates stays: the one with the smallest id."""
    return op1_near_dedup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return op5_decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), word_edges=True)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its sequence and offset there."""
    return op6_packing.pack(docs, tokenizer("word_bpe_49k.json"), 2)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Trained scores, near-duplicate classes and packing are not SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, name)
    return docs
