"""The two read queries: word explorer and yearly words, with their presentation helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import censor, concise_definition, format_count, format_decimal
from .broadcast import Dimension, dimension, join_dimension
from .fact import FACT_COLUMNS, missing_months, month_grid, zero_rows


def parse_words(text: str) -> list[str]:
    """User word list: lower, split on ``,``, strip, drop empty items, first occurrence order.
    (Same rule as :func:`lexitrend.functions.parse_word_list`, applied to a request string.)"""
    out: list[str] = []
    for w in text.lower().split(","):
        w = w.strip()
        if w and w not in out:
            out.append(w)
    return out


def _wanted(spark, words: Iterable[str]) -> DataFrame:
    return spark.createDataFrame([(w,) for w in words], "word string")


def word_explorer(words: DataFrame, definitions: DataFrame, word_list: str,
                  start=None, end=None) -> DataFrame:
    """Monthly series of each requested word that has both facts and a definition: its fact
    rows (NULL stddev -> 0.0) plus a zero row for every calendar month it lacks, ordered by
    word and month. Without ``start`` and ``end`` the calendar runs from the first to the last
    month of ``words``.

    The word filter is an ``IN`` list, so it reaches the Parquet scan, where files sorted by word
    let it skip row groups; the rest works on the requested words only.
    """
    start, end = month_grid(words, start, end)
    wanted = parse_words(word_list)
    facts = words.filter(F.col("word").isin(wanted)).select(*FACT_COLUMNS)
    defs = definitions.filter(F.col("word").isin(wanted)).select("word")
    facts = facts.join(defs, "word", "left_semi")
    facts = facts.withColumn("stddev_sentiment", F.coalesce("stddev_sentiment", F.lit(0.0)))
    series = facts.unionByName(zero_rows(missing_months(facts, start, end)))
    return series.orderBy("word", "year_month")


def word_summary(series: DataFrame, definitions: DataFrame) -> DataFrame:
    """Per word: ``total_count``, ``avg_avg_sentiment`` (mean over the series, zero months
    included), the definition and its concise form."""
    agg = series.groupBy("word").agg(
        F.sum("count").alias("total_count"),
        F.avg("avg_sentiment").alias("avg_avg_sentiment"),
    )
    return agg.join(definitions, "word").select(
        "word", "total_count", "avg_avg_sentiment", "definition",
        concise_definition("definition").alias("concise_definition"),
    )


def word_summary_display(summary: DataFrame) -> DataFrame:
    """The summary as display text: ``1,234`` and ``0.12``."""
    return summary.select(
        "word",
        format_count("total_count").alias("total_count_text"),
        format_decimal("avg_avg_sentiment", 2).alias("avg_sentiment_text"),
    )


def words_not_found(words: DataFrame, definitions: DataFrame, word_list: str) -> DataFrame:
    """Requested words lacking facts or a definition (the read returns the others)."""
    wanted = parse_words(word_list)
    spark = words.sparkSession
    req = _wanted(spark, wanted)
    have = (words.filter(F.col("word").isin(wanted)).select("word").distinct()
            .join(definitions.filter(F.col("word").isin(wanted)).select("word"), "word", "left_semi"))
    return req.join(have, "word", "left_anti")


# word column of the yearly read -> (yearly table, its metric, score column of the read)
YEARLY_READ = {
    "neg_word": ("negative_sentiment_spikes", "sentiment_spike_year", "negative_sentiment_spike"),
    "pos_word": ("positive_sentiment_spikes", "sentiment_spike_year", "positive_sentiment_spike"),
    "top_spike": ("top_frequency_spikes", "frequency_spike", "top_frequency_spike"),
    "top_sentiment_word": ("top_sentiment", "avg_sentiment", "top_sentiment"),
    "bottom_sentiment_word": ("bottom_sentiment", "avg_sentiment", "bottom_sentiment"),
    "bottom_spike": ("bottom_frequency_spikes", "frequency_spike", "bottom_frequency_spike"),
}


def ordered(table: DataFrame) -> DataFrame:
    """A yearly table as it is read: by year, rank, then word."""
    return table.orderBy("year", "rank", "word")


def yearly_lists(trends: dict[str, DataFrame], year: int, allowed_years: Iterable[int] | None = None) -> DataFrame:
    """The six yearly tables of one year by rank: ``(year, rank)`` and for each word column of
    :data:`YEARLY_READ` a list of ``(word, score)`` in word order (empty where the table has no such
    rank). The year filter reaches every table; they are stacked and grouped once.

    ``allowed_years`` restricts the years a caller may ask for (the original read offered
    ``constants.YEARLY_READ_YEARS``); ``None`` allows any year."""
    if allowed_years is not None and year not in set(allowed_years):
        raise ValueError(f"year {year} is not one of {sorted(set(allowed_years))}")
    stacked = None
    for word_col, (table, metric, _) in YEARLY_READ.items():
        t = trends[table].filter(F.year("year") == year).select(
            "year", "rank", F.lit(word_col).alias("_chart"), F.struct("word", F.col(metric).alias("score")).alias("_e"))
        stacked = t if stacked is None else stacked.unionByName(t)
    return stacked.groupBy("year", "rank").agg(*[
        F.array_sort(F.collect_list(F.when(F.col("_chart") == w, F.col("_e")))).alias(w) for w in YEARLY_READ])


def yearly_by_position(trends: dict[str, DataFrame], year: int,
                       allowed_years: Iterable[int] | None = None) -> DataFrame:
    """The six yearly tables side by side with tied words below each other: a rank has as many rows
    (``position`` 1, 2, ...) as its longest tie, and a shorter list leaves NULL."""
    lists = yearly_lists(trends, year, allowed_years)
    rows = lists.select("year", "rank", F.posexplode(F.arrays_zip(*YEARLY_READ)).alias("_at", "_z"))
    return rows.select("year", "rank", (F.col("_at") + 1).cast("long").alias("position"), *[
        c for w, (_, _, s) in YEARLY_READ.items() for c in (
            F.col(f"_z.{w}.word").alias(w), F.col(f"_z.{w}.score").alias(s))])


def yearly_words(trends: dict[str, DataFrame], year: int,
                 allowed_years: Iterable[int] | None = None) -> DataFrame:
    """The six yearly tables side by side by ``(year, rank)`` for one year, as the original read gave
    them: tied ranks multiply rows and a rank missing from any table drops the row. (Use
    :func:`yearly_by_position` for rows that do not multiply.)"""
    rows = yearly_lists(trends, year, allowed_years)
    for w in YEARLY_READ:                               # an empty list drops the rank
        rows = rows.withColumn(w, F.explode(w))
    return rows.select("year", *[c for w, (_, _, s) in YEARLY_READ.items() for c in (
        F.col(f"{w}.word").alias(w), F.col(f"{w}.score").alias(s))], "rank")


def censor_words(df: DataFrame, bad: DataFrame, columns: Iterable[str] = C.YEARLY_WORD_COLUMNS) -> DataFrame:
    """Mask bad words in each word column: first letter, then ``*`` for the rest.

    The bad-word list is a dimension: it is materialized and measured once, then each column
    gets one left join with it."""
    bad_set = dimension(bad.select("word").distinct())
    out = df
    for c in columns:
        flag = f"_bad_{c}"
        out = join_dimension(out, Dimension(bad_set.df.select(
            F.col("word").alias(c), F.lit(True).alias(flag)), bad_set.size), c, "left")
        out = out.withColumn(c, censor(c, F.coalesce(F.col(flag), F.lit(False)))).drop(flag)
    return out.select(*df.columns)


def trend_top10(trends: dict[str, DataFrame], year: int, k: int = 10) -> DataFrame:
    """For each of the six charts (one per yearly table), the ``k`` best words of a year as
    ``(chart, position, word, score)``: by rank, ties by word. Each chart comes from its own
    table, so tied ranks show different words; one window ranks all six."""
    stacked = None
    for table, metric, chart in YEARLY_READ.values():
        t = trends[table].filter(F.year("year") == year).select(
            F.lit(chart).alias("chart"), "word", F.col(metric).alias("score"),
            F.col("rank").alias("_order"))
        stacked = t if stacked is None else stacked.unionByName(t)
    best = Window.partitionBy("chart").orderBy("_order", "word")
    return stacked.withColumn("position", F.row_number().over(best).cast("long")).filter(
        F.col("position") <= k).select("chart", "position", "word", "score")
