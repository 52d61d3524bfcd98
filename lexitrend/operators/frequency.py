"""Monthly n-gram counts and frequencies (one plan over all months, one action)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ngrams, tokens
from ..session import release_shuffles, stored
from .broadcast import Dimension, broadcast_bounded, dimension, join_dimension


def ngram_rows(comments: DataFrame, n: int = 1, body: str = "body") -> DataFrame:
    """One row per n-gram occurrence: ``(year_month, word)``. The tokeniser sits inside
    ``explode`` so it runs once per comment."""
    return comments.select("year_month", F.explode(ngrams(tokens(body), n)).alias("word"))


def word_counts(comments: DataFrame, n: int = 1, body: str = "body") -> DataFrame:
    """``(year_month, word, count)``. Counting is partial per task, then shuffled by key, so a
    hot word costs one row per task in the shuffle."""
    return ngram_rows(comments, n, body).groupBy("year_month", "word").agg(
        F.count(F.lit(1)).alias("count"))


def month_totals(counts: DataFrame) -> DataFrame:
    """``(year_month, total)``: one row per month."""
    return counts.groupBy("year_month").agg(F.sum("count").alias("total"))


def with_frequency(counts: DataFrame) -> DataFrame:
    """Add ``frequency = count / month total``.

    Totals are joined back by broadcast: one row per month, so their size is bounded by the
    calendar, not by the data. A window ``sum() over (partition by month)`` would instead put a
    whole month's vocabulary in one task. A zero total gives NULL, not an error.
    """
    totals = broadcast_bounded(month_totals(counts))
    return counts.join(totals, "year_month").select(
        "year_month", "word", "count",
        F.try_divide(F.col("count"), F.col("total")).alias("frequency"),
    )


#: Begins the entry that stands for a comment's number of n-grams (it occurs in no token).
_TOTAL = "\u0000"


def with_size(grams: Column) -> Column:
    """A list with one more entry, which holds the list's length; a NULL list stays NULL."""
    # The list is bound once (see functions.ngrams).
    return F.transform(F.array(grams), lambda g: F.concat(
        g, F.array(F.concat(F.lit(_TOTAL), F.size(g).cast("string"))))).getItem(0)


def is_size(entry: Column) -> Column:
    return entry.startswith(_TOTAL)


def size_of(entry: Column) -> Column:
    return F.substring(entry, 2, 19).cast("long")


def counts_and_totals(comments: DataFrame, n: int = 1, body: str = "body") -> DataFrame:
    """``(year_month, word, count)`` of every n-gram, and a row with a NULL word for each month that
    counts all of them: each comment adds one entry with its number of n-grams to the list that is
    exploded, so counts and totals come out of one pass and one aggregate."""
    # A NULL body has no list and no entry.
    rows = comments.select("year_month", F.explode(with_size(ngrams(tokens(body), n))).alias("_e"))
    total = is_size(F.col("_e"))
    return rows.select("year_month", F.when(~total, F.col("_e")).alias("word"),
                       F.when(total, size_of(F.col("_e"))).otherwise(1).alias("_n")).groupBy(
        "year_month", "word").agg(F.sum("_n").alias("count"))


def monthly_ngrams(comments: DataFrame, n: int = 1, body: str = "body") -> DataFrame:
    """``(year_month, word, count, frequency)`` for n-grams of order ``n``.

    Words recur, so their counts are stored after one tokenising pass and divided by the month totals
    as a table (and the totals of it read only their own rows). Longer n-grams hardly recur: see
    :func:`clustered_ngrams`."""
    if n > 1:
        return clustered_ngrams(comments, n, body)
    return shares(stored(counts_and_totals(comments, n, body), "ngrams"))


def shares(counted: DataFrame) -> DataFrame:
    """Counts and totals (as of :func:`counts_and_totals`) as counts and frequencies."""
    return share_of(counted.filter("word is not null"),
                    counted.filter("word is null").select("year_month", F.col("count").alias("_total")))


def share_of(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Counts with their share of ``(year_month, _total)``, which has one row per month."""
    return counts.join(broadcast_bounded(totals), "year_month").select(
        "year_month", "word", "count", F.try_divide(F.col("count"), F.col("_total")).alias("frequency"))


#: A month of up to so many n-grams is always counted by one task, one of more than MOST never is.
#: A task that counts MOST of them spills a few GB. The texts are dealt over a partition for each PART.
LEAST, MOST, PART = 1 << 21, 1 << 27, 1 << 19


def token_texts(comments: DataFrame, n: int, body: str = "body") -> DataFrame:
    """``(year_month, text, grams)`` of each comment with a month and a body: its tokens joined by one
    space (no token holds white space, so splitting at it gives them back), and its number of n-grams."""
    # The token list is bound once (see functions.ngrams).
    both = F.transform(F.array(tokens(body)), lambda t: F.struct(
        F.array_join(t, " ").alias("text"),
        F.greatest(F.size(t) - (n - 1), F.lit(0)).cast("long").alias("grams"))).getItem(0)
    return comments.filter(F.col("year_month").isNotNull() & F.col(body).isNotNull()).select(
        "year_month", both.alias("_t")).select("year_month", "_t.text", "_t.grams")


def clustered_ngrams(comments: DataFrame, n: int, body: str = "body") -> DataFrame:
    """:func:`monthly_ngrams` for n-grams that hardly recur, whose rows would take many times the room
    of the texts: the texts are shuffled by month and each month's n-grams are put together and counted
    where its texts are, so no n-gram is shuffled or stored.

    The comments are tokenised once and stored; totals read the table's numbers alone. A month that is
    too large for one task (see :func:`month_limit`) has its n-grams shuffled, as :func:`word_counts` does.
    """
    spark = comments.sparkSession
    texts = stored(token_texts(comments, n, body), "texts", compression="zstd")
    release_shuffles(spark)
    totals = texts.groupBy("year_month").agg(F.sum("grams").alias("_total"))
    # One number per month: bounded by the calendar.
    sizes = [r["_total"] for r in totals.select("_total").collect()]
    limit = month_limit(sum(sizes), spark.sparkContext.defaultParallelism)
    large = broadcast_bounded(totals.filter(F.col("_total") > limit).select("year_month"))
    any_large = any(size > limit for size in sizes)
    rest = texts.join(large, "year_month", "left_anti") if any_large else texts
    # A number of its own, or Spark joins partitions until their texts, a tenth of what counting takes,
    # are large. Beyond four a month more would hardly part the months further.
    parts = max(1, min(sum(sizes) // PART, 4 * len(sizes)))
    counts = count_texts(rest.repartition(parts, "year_month"), n)
    if any_large:
        counts = counts.unionByName(count_texts(texts.join(large, "year_month", "left_semi"), n))
    return share_of(counts, totals)


def month_limit(grams: int, cores: int) -> int:
    """Most n-grams of a month that one task counts, of ``grams`` in all: twice a core's part of them,
    within LEAST and MOST."""
    return min(max(LEAST, 2 * grams // max(cores, 1)), MOST)


def count_texts(texts: DataFrame, n: int) -> DataFrame:
    """``(year_month, word, count)`` of :func:`token_texts`; texts that are clustered by month are counted
    where they are."""
    return texts.select("year_month", F.explode(ngrams(F.split("text", " "), n)).alias("word")).groupBy(
        "year_month", "word").agg(F.count(F.lit(1)).alias("count"))


def monthly_ngrams_of(comments: DataFrame, words: DataFrame | Dimension, n: int = 1,
                     body: str = "body") -> DataFrame:
    """:func:`monthly_ngrams` restricted to the n-grams in ``words`` (same counts, same
    frequencies: the month total still counts every n-gram).

    One tokenising pass: each n-gram is looked up in the (measured, broadcast) word set and any
    n-gram outside it is counted under a NULL key, so the aggregate holds the wanted words plus
    one row per month instead of the whole vocabulary. Used where only bank words can survive a
    later join (the fact table).
    """
    words = dimension(words if isinstance(words, Dimension) else words.select("word").distinct())
    wanted = Dimension(words.df.withColumn("_hit", F.lit(True)), words.size)
    tagged = join_dimension(ngram_rows(comments, n, body), wanted, "word", "left").select(
        "year_month", F.when(F.col("_hit"), F.col("word")).alias("word"))
    agg = tagged.groupBy("year_month", "word").agg(F.count(F.lit(1)).alias("count"))
    totals = broadcast_bounded(month_totals(agg))
    return agg.filter(F.col("word").isNotNull()).join(totals, "year_month").select(
        "year_month", "word", "count",
        F.try_divide(F.col("count"), F.col("total")).alias("frequency"),
    )


def top_words(counts: DataFrame, k: int, per_month: bool = True) -> DataFrame:
    """The ``k`` most frequent words (ties by word), per month or overall.

    Per month this is ``row_number() <= k``, which Spark plans as a partial group limit before
    the shuffle; overall it is ``orderBy().limit()`` (a single top-k, no global sort)."""
    order = [F.col("count").desc(), F.col("word").asc()]
    if not per_month:
        return counts.orderBy(*order).limit(k)
    w = Window.partitionBy("year_month").orderBy(*order)
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
