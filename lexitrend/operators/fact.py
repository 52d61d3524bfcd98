"""The monthly fact table ``words`` and its maintenance steps."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import month_sequence
from ..schemas import WORDS_KEY
from .bank import remove_stopwords

FACT_COLUMNS = ("word", "year_month", "count", "frequency", "avg_sentiment", "stddev_sentiment")


def words_fact(ngrams: DataFrame, sentiment: DataFrame, stopwords: DataFrame | None = None) -> DataFrame:
    """Inner join of monthly counts and monthly sentiment on ``(year_month, word)``, after
    removing stopwords from the sentiment side: only bank words seen that month remain.

    Both inputs leave their aggregates hash-partitioned on ``(year_month, word)``, so the join
    adds no exchange of its own.
    """
    sent = remove_stopwords(sentiment, stopwords) if stopwords is not None else sentiment
    return ngrams.join(sent, ["year_month", "word"], "inner").select(*FACT_COLUMNS)


def key_duplicates(words: DataFrame) -> DataFrame:
    """One row: how many ``(word, year_month)`` keys occur more than once (0 when unique)."""
    dup = words.groupBy(*WORDS_KEY).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return dup.agg(F.count(F.lit(1)).alias("duplicate_keys"))


def append_new_words(new: DataFrame, existing: DataFrame, key: Sequence[str] = WORDS_KEY) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing``, one per key (of several in ``new`` any
    one); a re-run of a month that is already loaded adds nothing, and other months still go in."""
    return new.dropDuplicates(list(key)).join(existing.select(*key).distinct(), list(key), "left_anti")


def distinct_words(words: DataFrame) -> DataFrame:
    return words.select("word").distinct()


def calendar_bounds(df: DataFrame, column: str = "year_month") -> tuple[dt.date, dt.date]:
    """First and last month present (one single-row aggregate)."""
    row = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    return row["lo"], row["hi"]


def calendar(spark, start, end) -> DataFrame:
    """``DataFrame(year_month)``: every first of month from ``start`` to ``end``."""
    return spark.range(1).select(
        F.explode(month_sequence(F.to_date(F.lit(str(start))), F.to_date(F.lit(str(end)))))
        .alias("year_month"))


def month_grid(words: DataFrame, start=None, end=None) -> tuple[dt.date, dt.date]:
    """The calendar of a fact table: its first and last month unless given."""
    if start is None or end is None:
        first, last = calendar_bounds(words)
        return start or first, end or last
    return start, end


def month_number(month: dt.date) -> int:
    return month.year * 12 + month.month - 1


def month_of(number: int) -> dt.date:
    return dt.date(number // 12, number % 12 + 1, 1)


def months_between(first: dt.date, last: dt.date) -> list[dt.date]:
    return [month_of(n) for n in range(month_number(first), month_number(last) + 1)]


def _number(month: Column) -> Column:
    return F.year(month) * 12 + F.month(month) - 1


def month_bitmaps(words: DataFrame, base: int, slots: int) -> DataFrame:
    """``(word, bits)``: one bit per month a word has rows for, counted from month number ``base``,
    in ``slots`` whole numbers of 64 bits. A word's bits are partial per task and merge by OR; rows
    outside the bits give a word without setting any."""
    at = _number(F.col("year_month")) - F.lit(base)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int"))
    none = F.lit(0).cast("long")
    return words.groupBy("word").agg(F.array(*[
        F.bit_or(F.when(F.floor(at / 64) == k, bit).otherwise(none)) for k in range(slots)]).alias("bits"))


def merge_bitmaps(bitmaps: DataFrame, slots: int, *flags: str) -> DataFrame:
    """One row per word: the OR of its bits (missing slots count as 0) and the largest of each flag."""
    return bitmaps.groupBy("word").agg(F.array(*[
        F.coalesce(F.bit_or(F.get("bits", F.lit(k))), F.lit(0).cast("long")) for k in range(slots)]).alias("bits"),
        *[F.max(c).alias(c) for c in flags])


def gaps(bitmaps: DataFrame, base: int, months: Sequence[dt.date]) -> DataFrame:
    """``(word, year_month)`` of the given months that a word's bits lack."""
    if not months:
        return bitmaps.select("word", F.lit(None).cast("date").alias("year_month")).limit(0)
    wanted = F.array(*[F.struct(F.lit(m).alias("m"), F.lit((month_number(m) - base) // 64).alias("slot"),
                                F.lit((month_number(m) - base) % 64).alias("bit")) for m in months])
    lacks = F.filter(wanted, lambda x: F.call_function("getbit", F.get("bits", x["slot"]), x["bit"]) == 0)
    return bitmaps.select("word", F.explode(lacks).alias("_x")).select("word", F.col("_x.m").alias("year_month"))


def slots_of(first: dt.date, last: dt.date) -> int:
    return (month_number(last) - month_number(first)) // 64 + 1


def missing_months(words: DataFrame, start, end) -> DataFrame:
    """``(word, year_month)`` for every calendar month a word has no row for, from month bitmaps: a
    word is one row of a few whole numbers in the shuffle, however many rows it has."""
    if start is None or end is None:  # an empty table has no calendar and no gaps
        return words.select("word", "year_month").limit(0)
    first, last = (dt.date.fromisoformat(str(x)).replace(day=1) for x in (start, end))
    if first > last:
        return words.select("word", "year_month").limit(0)
    base = month_number(first)
    return gaps(month_bitmaps(words, base, slots_of(first, last)), base, months_between(first, last))


def zero_rows(missing: DataFrame) -> DataFrame:
    return missing.select(
        "word", "year_month",
        F.lit(0).cast("long").alias("count"), F.lit(0.0).alias("frequency"),
        F.lit(0.0).alias("avg_sentiment"), F.lit(0.0).alias("stddev_sentiment"),
    )


def densify(words: DataFrame, start=None, end=None) -> DataFrame:
    """Fact table plus a zero row for every (word, calendar month) it lacks: words x months. The
    calendar runs from the table's first to its last month unless bounds are given."""
    start, end = month_grid(words, start, end)
    return words.select(*FACT_COLUMNS).unionByName(zero_rows(missing_months(words, start, end)))
