"""All fixed schemas in one place. Nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw comment, one JSON object per line. Only these fields are ever used.
RAW_COMMENT = T.StructType(
    [
        T.StructField("body", T.StringType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("score", T.LongType()),
        T.StructField("ups", T.LongType()),
        T.StructField("downs", T.LongType()),
    ]
)

# Comment rows as the monthly jobs see them.
COMMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("year_month", T.DateType()),
    ]
)

# Dictionary CSV (header row). Other columns in the file are ignored.
DICTIONARY = T.StructType(
    [
        T.StructField("word", T.StringType()),
        T.StructField("definition", T.StringType()),
        T.StructField("up_votes", T.LongType()),
    ]
)

NGRAM_COUNTS = T.StructType(
    [
        T.StructField("year_month", T.DateType()),
        T.StructField("word", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("frequency", T.DoubleType()),
    ]
)

WORD_SENTIMENT = T.StructType(
    [
        T.StructField("year_month", T.DateType()),
        T.StructField("word", T.StringType()),
        T.StructField("avg_sentiment", T.DoubleType()),
        T.StructField("stddev_sentiment", T.DoubleType()),
    ]
)

# The monthly fact table, unique on (word, year_month).
WORDS = T.StructType(
    [
        T.StructField("word", T.StringType()),
        T.StructField("year_month", T.DateType()),
        T.StructField("count", T.LongType()),
        T.StructField("frequency", T.DoubleType()),
        T.StructField("avg_sentiment", T.DoubleType()),
        T.StructField("stddev_sentiment", T.DoubleType()),
    ]
)
WORDS_KEY = ("word", "year_month")

LEXICON = T.StructType(
    [
        T.StructField("word", T.StringType()),
        T.StructField("valence", T.DoubleType()),
    ]
)
BOOSTERS = T.StructType(
    [
        T.StructField("word", T.StringType()),
        T.StructField("scalar", T.DoubleType()),
    ]
)
WORD_LIST = T.StructType([T.StructField("word", T.StringType())])
