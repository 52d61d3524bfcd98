"""Word bank, definitions, stopwords and bank matching."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_single_word, strip_ws, tokens
from .broadcast import Dimension, join_dimension


def word_bank(source_words: DataFrame, stopwords: DataFrame, column: str = "word") -> DataFrame:
    """Bank of single words: one piece when split on one space, lower-cased, as a set, minus the
    lower-cased stopwords. Not punctuation-cleaned, so ``don't`` never matches ``dont``."""
    bank = (
        source_words.filter(is_single_word(column, any_whitespace=False))
        .select(F.lower(F.col(column)).alias("word"))
        .distinct()
    )
    stop = stopwords.select(F.lower(F.col("word")).alias("word")).distinct()
    return join_dimension(bank, stop, "word", "left_anti")


def definitions(dictionary: DataFrame) -> DataFrame:
    """``(word, definition)``: single words (any-whitespace split), key stripped and lower-cased,
    the definition with the most ``up_votes``; ties go to the smaller definition text, NULL
    votes and NULL definitions last.

    ``min_by`` is an aggregate, so it is computed partially per task before the shuffle: a word
    with very many definitions never gathers all its rows in one place.
    """
    d = dictionary.filter(is_single_word("word", any_whitespace=True)).select(
        F.lower(strip_ws("word")).alias("word"), "definition", "up_votes")
    order = F.struct(
        F.col("up_votes").isNull(), -F.col("up_votes"),
        F.col("definition").isNull(), F.col("definition"),
    )
    return d.groupBy("word").agg(F.min_by("definition", order).alias("definition"))


def remove_stopwords(df: DataFrame, stopwords: DataFrame, column: str = "word") -> DataFrame:
    """Drop rows whose ``column`` is a stopword (exact match; the list is used as given)."""
    stop = stopwords.select(F.col("word").alias(column)).distinct()
    return join_dimension(df, stop, column, "left_anti")


def matched_tokens(comments: DataFrame, bank: DataFrame | Dimension, key: str = "doc_id",
                   body: str = "body") -> DataFrame:
    """``(doc_id, year_month, word)`` for every token that is a bank word. A word used k times
    in a comment gives k rows (no dedupe)."""
    toks = comments.select(key, "year_month", F.explode(tokens(body)).alias("word"))
    return join_dimension(toks, bank, "word", "left_semi")


def matched_comments(comments: DataFrame, bank: DataFrame | Dimension, key: str = "doc_id",
                     body: str = "body") -> DataFrame:
    """Comments with at least one bank word: ``(doc_id, year_month, n_matched)``.
    A comment's tokens stay in one task, so the partial count is one row per comment."""
    return matched_tokens(comments, bank, key, body).groupBy(key, "year_month").agg(
        F.count(F.lit(1)).alias("n_matched"))
