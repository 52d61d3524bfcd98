"""Yearly roll-ups, spikes and the six ranked yearly tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import year_start


def yearly_rollup(words: DataFrame) -> DataFrame:
    """``(word, year, yearly_count, avg_frequency, avg_sentiment)``: sum of counts and the
    unweighted mean of the monthly values over the months present."""
    return words.groupBy("word", year_start("year_month").alias("year")).agg(
        F.sum("count").alias("yearly_count"),
        F.avg("frequency").alias("avg_frequency"),
        F.avg("avg_sentiment").alias("avg_sentiment"),
    )


def spike(df: DataFrame, metric: str, name: str) -> DataFrame:
    """Add ``name``: ``x - previous + x - next`` over a word's years present (NULL for the first
    and last year), and ``_size``, the largest of the three absolute values."""
    w = Window.partitionBy("word").orderBy("year")
    x, p, n = F.col(metric), F.col("_p"), F.col("_n")
    df = df.withColumns({"_p": F.lag(metric).over(w), "_n": F.lead(metric).over(w)})
    return df.withColumns({name: x - p + x - n, "_size": F.greatest(F.abs(x), F.abs(p), F.abs(n))}).drop("_p", "_n")


def to_digits(x: Column, size: Column, digits: int) -> Column:
    """``x`` rounded to ``digits`` significant decimal digits of ``size``: the same at every
    magnitude, so values that shrink as the corpus grows keep their order, while the last bits of
    float sums (whose order varies from task to task) decide nothing."""
    scale = F.pow(F.lit(10.0), F.lit(digits - 1.0) - F.floor(F.log10(size)))
    return F.when(size == 0, F.lit(0.0)).otherwise(F.round(x * scale) / scale)


def rank_within_year(df: DataFrame, metric: str, descending: bool, k: int = C.TOP_K,
                     key: Column | None = None) -> DataFrame:
    """``RANK()`` per year by ``key`` (default: ``metric`` to 12 decimals, for metrics of a fixed
    range such as sentiment), kept while ``rank <= k``. Ties share a rank, so a year may hold
    more than ``k`` rows.

    ``rank <= k`` directly over the window lets Spark place a partial per-year limit before the
    shuffle, so a year's partition never holds more than (tasks x k + ties) rows.
    """
    key = F.round(F.col(metric), C.SENTIMENT_DECIMALS) if key is None else key
    w = Window.partitionBy("year").orderBy(key.desc() if descending else key.asc())
    return (df.filter(F.col(metric).isNotNull())
            .withColumn("rank", F.rank().over(w).cast("long"))
            .filter(F.col("rank") <= k))


def _frequency_spikes(rollup: DataFrame) -> DataFrame:
    return spike(rollup.select("word", "year", "yearly_count", "avg_frequency"), "avg_frequency", "frequency_spike")


def frequency_spikes(rollup: DataFrame) -> DataFrame:
    return _frequency_spikes(rollup).drop("_size")


def sentiment_spikes(rollup: DataFrame, min_count: int = C.YEARLY_MIN_COUNT) -> DataFrame:
    """Threshold first, then the window: lag/lead skip years at or under ``min_count``."""
    base = rollup.filter(F.col("yearly_count") > min_count).select("word", "year", "yearly_count", "avg_sentiment")
    return spike(base, "avg_sentiment", "sentiment_spike_year").drop("_size")


def top_frequency_spikes(rollup: DataFrame, k: int = C.TOP_K, descending: bool = True) -> DataFrame:
    key = to_digits(F.col("frequency_spike"), F.col("_size"), C.RANK_DIGITS)
    ranked = rank_within_year(_frequency_spikes(rollup), "frequency_spike", descending, k, key)
    return ranked.select("word", "year", "yearly_count", "avg_frequency", "frequency_spike", "rank")


def bottom_frequency_spikes(rollup: DataFrame, k: int = C.TOP_K) -> DataFrame:
    return top_frequency_spikes(rollup, k, descending=False)


def positive_sentiment_spikes(rollup: DataFrame, min_count: int = C.YEARLY_MIN_COUNT,
                              k: int = C.TOP_K, descending: bool = True) -> DataFrame:
    ranked = rank_within_year(sentiment_spikes(rollup, min_count), "sentiment_spike_year",
                              descending, k)
    return ranked.select("word", "year", "yearly_count", "sentiment_spike_year", "rank")


def negative_sentiment_spikes(rollup: DataFrame, min_count: int = C.YEARLY_MIN_COUNT,
                              k: int = C.TOP_K) -> DataFrame:
    return positive_sentiment_spikes(rollup, min_count, k, descending=False)


def top_sentiment(rollup: DataFrame, min_count: int = C.YEARLY_MIN_COUNT, k: int = C.TOP_K,
                  descending: bool = True) -> DataFrame:
    base = rollup.filter(F.col("yearly_count") > min_count)
    ranked = rank_within_year(base, "avg_sentiment", descending, k)
    return ranked.select("word", "year", "avg_sentiment", "rank")


def bottom_sentiment(rollup: DataFrame, min_count: int = C.YEARLY_MIN_COUNT, k: int = C.TOP_K) -> DataFrame:
    return top_sentiment(rollup, min_count, k, descending=False)


TABLES = (
    "top_frequency_spikes", "bottom_frequency_spikes", "positive_sentiment_spikes",
    "negative_sentiment_spikes", "top_sentiment", "bottom_sentiment",
)


def yearly_trends(r: DataFrame, min_count: int = C.YEARLY_MIN_COUNT,
                  k: int = C.TOP_K) -> dict[str, DataFrame]:
    """The six yearly tables of a roll-up ``r``, lazily: a filter on the year reaches each rank's
    partitions. Pass a materialized roll-up when several are used."""
    return {
        "top_frequency_spikes": top_frequency_spikes(r, k),
        "bottom_frequency_spikes": bottom_frequency_spikes(r, k),
        "positive_sentiment_spikes": positive_sentiment_spikes(r, min_count, k),
        "negative_sentiment_spikes": negative_sentiment_spikes(r, min_count, k),
        "top_sentiment": top_sentiment(r, min_count, k),
        "bottom_sentiment": bottom_sentiment(r, min_count, k),
    }
