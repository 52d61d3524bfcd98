"""Reference inputs derived from the driver's tables.

The original job reads a forum-comment archive, a slang dictionary, a stopword file, a bad-word
file and a sentiment lexicon. None of these ship with the data here, so each is derived from the
driver tables by a fixed rule (see FIXTURES.md). Every derived frame is lazy and grows with the
tables it reads; the small inline lists are parameters, not data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import first_piece, month_start, tokens

# --- Fixed values: fixture parameters (inline lists) ----------------------------------------
# Stopwords: the twelve most frequent tokens of the documents table.
FIXTURE_STOPWORDS = ("the", "of", "de", "and", "to", "in", "la", "a", "der", "en", "is", "that")
# Sentiment lexicon over tokens that occur in the documents table: (word, valence).
FIXTURE_LEXICON = (
    ("this", 1.9), ("from", -1.5), ("with", 1.2), ("was", -0.8), ("are", 0.6), ("be", 1.1),
    ("by", -0.9), ("it", 0.3), ("et", 1.3), ("les", -1.1), ("und", 0.7), ("von", -1.4),
    ("que", 1.6), ("el", -0.6), ("den", 0.9), ("des", -0.4), ("ha", 2.1), ("ing", -2.0),
    ("the", 0.2), ("of", -0.3), ("de", 0.5), ("la", -0.5),
)
# Boosters: (word, scalar); +0.293 raises, -0.293 damps.
FIXTURE_BOOSTERS = (("at", 0.293), ("on", 0.293), ("er", 0.293), ("to", -0.293))
# Negations.
FIXTURE_NEGATIONS = ("nicht", "pas", "no")
# Bad words (before the fixed extras are added).
FIXTURE_BAD_WORDS = ("anon", "die", "eran", "thatin", "ononst")
# Yearly threshold used on this data in place of 100,000.
FIXTURE_YEARLY_MIN_COUNT = 20
# Words looked up by the word read: four with facts and a definition, one unknown.
FIXTURE_LOOKUP = "die, eran,anon , antion,zzzunknown"
FIXTURE_YEAR = 1998


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``comments(doc_id, subreddit, body, year_month)``: documents joined to orders on key.

    Both sides grow with the data (orders is 15x documents), so this is a sort-merge join on the
    key (hinted, so neither side is broadcast and both may spill); the comments come out partitioned
    on ``doc_id`` across the shuffle partitions, which is what spreads the per-comment tokenising
    over all cores even where the documents are one Parquet row group.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return docs.join(orders.hint("merge"), docs["doc_id"] == orders["o_orderkey"], "inner").select(
        F.col("doc_id"),
        F.col("source").alias("subreddit"),
        F.col("text").alias("body"),
        month_start("o_orderdate").alias("year_month"),
    )


def bank_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw word column of the slang dictionary: distinct tokens of ``benchmark.text``."""
    bench = table(spark, sf_dir, "benchmark")
    return bench.select(F.explode(tokens("text")).alias("word")).distinct()


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(word, definition, up_votes)`` from ``conversations``: key = text up to the first
    ``.`` or ``,``; definition = the text; up_votes = its length."""
    conv = table(spark, sf_dir, "conversations")
    return conv.select(
        first_piece("text").alias("word"),
        F.col("text").alias("definition"),
        F.length("text").cast("long").alias("up_votes"),
    )


def _word_frame(spark: SparkSession, words) -> DataFrame:
    return spark.createDataFrame([(w,) for w in words], schemas.WORD_LIST)


def stopwords(spark: SparkSession) -> DataFrame:
    return _word_frame(spark, FIXTURE_STOPWORDS)


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(FIXTURE_LEXICON), schemas.LEXICON)


def boosters(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(FIXTURE_BOOSTERS), schemas.BOOSTERS)


def negations(spark: SparkSession) -> DataFrame:
    return _word_frame(spark, FIXTURE_NEGATIONS)


def bad_words_source(spark: SparkSession) -> DataFrame:
    return _word_frame(spark, FIXTURE_BAD_WORDS)


# --- SQL text of the same fixtures, for DuckDB oracles over the same Parquet views ------------

def sql_values(rows, columns: str) -> str:
    def lit(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return repr(float(v))

    body = ", ".join("(" + ", ".join(lit(v) for v in (r if isinstance(r, tuple) else (r,))) + ")"
                     for r in rows)
    return f"(VALUES {body}) AS v({columns})"
