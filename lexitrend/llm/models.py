"""Shared by the classifiers: a bounded sample of labelled rows, and scores of whole texts."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, slices, staged, texts_of

#: Labelled rows a classifier is fitted on, at most; chosen by a hash of the id.
MAX_TRAIN_ROWS = 20_000


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column,
                    id_col: str = "doc_id", text_col: str = "text", limit: int = MAX_TRAIN_ROWS) -> DataFrame:
    """``(_label, _text)`` of at most ``limit`` labelled rows that ``train`` allows.

    Ids with several labels count by the largest; null labels and ids are left out. The chosen
    ids are bounded by ``limit``, so they are broadcast and only the sample's texts are shuffled;
    of rows that repeat an id the smallest text counts.
    """
    chosen = staged(labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_label"))
                    .filter("_id is not null and _label is not null")
                    .groupBy("_id").agg(F.max("_label").alias("_label"))
                    .withColumnRenamed("_id", id_col).filter(train).withColumnRenamed(id_col, "_id")
                    .orderBy(F.xxhash64("_id"), "_id").limit(limit), "sample_ids")
    return docs.select(F.col(id_col).alias("_doc"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
                       .alias("_text")).join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select(
        "_id", "_label", "_text").groupBy("_id").agg(F.max("_label").alias("_label"), F.min("_text").alias("_text"))


def score_column(text: Column, scorer: Callable[[list[str]], np.ndarray], spark: SparkSession) -> Column:
    """The score of each whole text, in Arrow batches; rows stay where they are."""
    ship(spark)

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        parts = [scorer(texts_of(texts, lo, hi)) for lo, hi in slices(texts)]
        return pa.array(np.concatenate(parts) if parts else np.empty(0), pa.float64())

    return run(text)


def score_all(docs: DataFrame, scorer: Callable[[list[str]], np.ndarray], held_out: Column,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; scores depend on the text alone."""
    scored = docs.select(F.col(id_col).alias("doc_id"), held_out.alias("held_out"), score_column(
        F.col(text_col).cast("string"), scorer, docs.sparkSession).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))
