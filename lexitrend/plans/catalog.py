"""Registered queries over the driver tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame; queries on the fact table first
materialize it (and the roll-up) as the jobs would. Inputs are derived from the
driver tables by the rules in :mod:`lexitrend.sources.testdata`, so every query's work grows
with the tables. Monthly sentiment comes out of whole-number moments and is compared as it is;
averages of averages (the yearly roll-up) come out of float sums and are rounded to 10 decimals here
and in the oracle SQL, so that summation order cannot change the compared value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import concise_definition, parse_word_list, tokens
from ..operators import bank as B
from ..operators import explore as X
from ..operators import fact as FT
from ..operators import frequency as FQ
from ..operators import sentiment as S
from ..operators import trends as TR
from ..operators.broadcast import Dimension, dimension
from ..sources import comments as SC
from ..sources import lists as L
from ..sources import sinks as SK
from ..sources import testdata as TD
from ..session import ensure_checkpoint_dir

ROUND = 10
# Frequencies shrink as a corpus grows: compared to significant digits, spikes (differences of
# frequencies, so their last digits are noise) to fewer.
FREQUENCY_DIGITS, SPIKE_DIGITS = 9, 6
SAMPLE_TARGET = 5          # comments per month kept by the sampling query
SAMPLE_SEED = 42
RANGE_START, RANGE_END = "1996-03-01", "2000-05-01"
LOADED_BEFORE = "1998-01-01"   # months before this are "already loaded" in append_new_words
OFFERED_FROM = "1997-01-01"    # the batch offered to append_new_words starts here
TOP_WORDS_K = 10


def _r(c: str) -> F.Column:
    if "frequency" in c:
        return TR.to_digits(F.col(c), F.abs(F.col(c)), SPIKE_DIGITS if "spike" in c else FREQUENCY_DIGITS).alias(c)
    return F.round(F.col(c), ROUND).alias(c)


class Inputs:
    """Inputs for one ``sf_dir``, built once per query.

    The stages the batch jobs write as tables (monthly n-grams, monthly sentiment, the fact
    table and the yearly roll-up) are checkpointed to the session's checkpoint directory when
    first used: later steps read the materialized rows instead of re-planning the whole chain,
    exactly as the reads read written tables in production. ``stages`` keeps the plan of each
    such stage before its checkpoint, for plan reports.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._memo: dict[str, object] = {}
        self.stages: dict[str, DataFrame] = {}
        ensure_checkpoint_dir(spark)

    def _once(self, name: str, build: Callable[[], object]):
        if name not in self._memo:
            self._memo[name] = build()
        return self._memo[name]

    def _materialize(self, name: str, df: DataFrame) -> DataFrame:
        self.stages[name] = df
        return df.checkpoint(eager=True)

    def comments(self) -> DataFrame:
        return TD.comments(self.spark, self.sf_dir)

    def stopwords(self) -> DataFrame:
        return TD.stopwords(self.spark)

    def bank(self) -> Dimension:
        return self._once("bank", lambda: dimension(B.word_bank(
            TD.bank_source(self.spark, self.sf_dir), self.stopwords())))

    def definitions(self) -> DataFrame:
        return self._once("definitions", lambda: B.definitions(TD.dictionary(self.spark, self.sf_dir)))

    def ngrams(self, n: int = 1) -> DataFrame:
        return FQ.monthly_ngrams(self.comments(), n)

    def sentiment(self) -> DataFrame:
        return self._once("sentiment", lambda: S.monthly_word_sentiment(
            self.comments(), self.bank(), TD.lexicon(self.spark), TD.boosters(self.spark),
            TD.negations(self.spark)))

    def words(self) -> DataFrame:
        # Only bank words can survive the join of counts and sentiment (and the bank holds no
        # stopword), so one pass over the comments gives the facts.
        return self._once("words", lambda: self._materialize("words", S.monthly_word_facts(
            self.comments(), self.bank(), TD.lexicon(self.spark), TD.boosters(self.spark),
            TD.negations(self.spark)).select(*FT.FACT_COLUMNS)))

    def rollup(self) -> DataFrame:
        return self._once("rollup", lambda: self._materialize("rollup", TR.yearly_rollup(self.words())))

    def trends(self) -> dict[str, DataFrame]:
        """The six yearly tables, lazily over the roll-up: a year filter reaches every rank."""
        return TR.yearly_trends(self.rollup(), TD.FIXTURE_YEARLY_MIN_COUNT)

    def bad_words(self) -> DataFrame:
        return L.bad_words(TD.bad_words_source(self.spark))


def _q(fn: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Inputs(spark, sf_dir))
    run.of = fn
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def plans_of(spark: SparkSession, sf_dir: str, name: str) -> dict[str, str]:
    """The physical plans of a query as planned before adaptive execution: those of the stages it
    materializes, and its own."""
    inputs = Inputs(spark, sf_dir)
    out = QUERIES[name].of(inputs)
    frames = {**inputs.stages, name: out}
    plans = {k: df._jdf.queryExecution().executedPlan().toString() for k, df in frames.items()}
    return {k: p.split("== Initial Plan ==")[-1] for k, p in plans.items()}


# --- scans --------------------------------------------------------------------------------

def comments_scan(i: Inputs) -> DataFrame:
    return i.comments().select("doc_id", "subreddit", "body", "year_month")


def month_range_scan(i: Inputs) -> DataFrame:
    c = SC.month_range(i.comments(), RANGE_START, RANGE_END)
    return c.select("doc_id", "subreddit", "year_month")


def row_count(i: Inputs) -> DataFrame:
    return i.words().agg(F.count(F.lit(1)).alias("row_count"))


# --- text ---------------------------------------------------------------------------------

def tokenize(i: Inputs) -> DataFrame:
    c = i.comments()
    return c.select("doc_id", F.posexplode(tokens("body")).alias("pos", "token")).select(
        "doc_id", F.col("pos").cast("long").alias("pos"), "token")


def parse_word_list_q(i: Inputs) -> DataFrame:
    d = TD.table(i.spark, i.sf_dir, "documents")
    return d.select("doc_id", F.posexplode(parse_word_list("text")).alias("pos", "item")).select(
        "doc_id", F.col("pos").cast("long").alias("pos"), "item")


def concise_definition_q(i: Inputs) -> DataFrame:
    conv = TD.table(i.spark, i.sf_dir, "conversations")
    return conv.select("conv_id", "turn", concise_definition("text").alias("concise_definition"))


def censor_words(i: Inputs) -> DataFrame:
    return X.censor_words(X.yearly_words(i.trends(), TD.FIXTURE_YEAR), i.bad_words()).select(
        "year", "rank", "neg_word", "pos_word", "top_spike", "top_sentiment_word",
        "bottom_sentiment_word", "bottom_spike")


# --- counts -------------------------------------------------------------------------------

def word_counts(i: Inputs) -> DataFrame:
    return FQ.word_counts(i.comments(), 1)


def word_frequencies(i: Inputs) -> DataFrame:
    return i.ngrams(1)


def top_words(i: Inputs) -> DataFrame:
    return FQ.top_words(FQ.word_counts(i.comments(), 1), TOP_WORDS_K).select(
        "year_month", "word", "count", F.col("rank").cast("long").alias("rank"))


def bigram_counts(i: Inputs) -> DataFrame:
    return i.ngrams(2)


def trigram_counts(i: Inputs) -> DataFrame:
    return i.ngrams(3)


# --- bank ---------------------------------------------------------------------------------

def word_bank(i: Inputs) -> DataFrame:
    return i.bank().df


def definitions(i: Inputs) -> DataFrame:
    return i.definitions()


def matched_tokens(i: Inputs) -> DataFrame:
    return B.matched_tokens(i.comments(), i.bank()).select("doc_id", "year_month", "word")


def matched_comments(i: Inputs) -> DataFrame:
    return B.matched_comments(i.comments(), i.bank())


def remove_stopwords(i: Inputs) -> DataFrame:
    return B.remove_stopwords(FQ.word_counts(i.comments(), 1), i.stopwords())


# --- sentiment ----------------------------------------------------------------------------

def lexicon_sentiment(i: Inputs) -> DataFrame:
    return S.lexicon_sentiment(i.comments(), TD.lexicon(i.spark), TD.boosters(i.spark),
                               TD.negations(i.spark))


def sample_to_target(i: Inputs) -> DataFrame:
    return S.sample_to_target(i.comments(), SAMPLE_TARGET, SAMPLE_SEED).select("doc_id", "year_month")


def word_sentiment(i: Inputs) -> DataFrame:
    return i.sentiment().select("year_month", "word", "avg_sentiment", "stddev_sentiment")


# --- fact ---------------------------------------------------------------------------------

def _fact_out(df: DataFrame) -> DataFrame:
    return df.select(*FT.FACT_COLUMNS)


def words_fact(i: Inputs) -> DataFrame:
    return _fact_out(i.words())


def words_key_check(i: Inputs) -> DataFrame:
    return FT.key_duplicates(i.words())


def append_new_words(i: Inputs) -> DataFrame:
    w = i.words()
    existing = w.filter(F.col("year_month") < F.to_date(F.lit(LOADED_BEFORE)))
    offered = w.filter(F.col("year_month") >= F.to_date(F.lit(OFFERED_FROM)))
    return _fact_out(FT.append_new_words(offered, existing))


def distinct_words(i: Inputs) -> DataFrame:
    return FT.distinct_words(i.words())


def densify_months(i: Inputs) -> DataFrame:
    return _fact_out(FT.densify(i.words()))


# --- yearly -------------------------------------------------------------------------------

def yearly_frequency(i: Inputs) -> DataFrame:
    return i.rollup().select("word", "year", "yearly_count", _r("avg_frequency"))


def yearly_sentiment(i: Inputs) -> DataFrame:
    return i.rollup().select("word", "year", "yearly_count", _r("avg_sentiment"))


def frequency_spike(i: Inputs) -> DataFrame:
    return TR.frequency_spikes(i.rollup()).select(
        "word", "year", "yearly_count", _r("avg_frequency"), _r("frequency_spike"))


def sentiment_spike(i: Inputs) -> DataFrame:
    return TR.sentiment_spikes(i.rollup(), TD.FIXTURE_YEARLY_MIN_COUNT).select(
        "word", "year", "yearly_count", _r("avg_sentiment"), _r("sentiment_spike_year"))


def _freq_table(df: DataFrame) -> DataFrame:
    return df.select("word", "year", "yearly_count", _r("avg_frequency"), _r("frequency_spike"), "rank")


def _spike_table(df: DataFrame) -> DataFrame:
    return df.select("word", "year", "yearly_count", _r("sentiment_spike_year"), "rank")


def _sent_table(df: DataFrame) -> DataFrame:
    return df.select("word", "year", _r("avg_sentiment"), "rank")


def top_frequency_spikes(i: Inputs) -> DataFrame:
    return _freq_table(TR.top_frequency_spikes(i.rollup()))


def bottom_frequency_spikes(i: Inputs) -> DataFrame:
    return _freq_table(TR.bottom_frequency_spikes(i.rollup()))


def positive_sentiment_spike(i: Inputs) -> DataFrame:
    return _spike_table(TR.positive_sentiment_spikes(i.rollup(), TD.FIXTURE_YEARLY_MIN_COUNT))


def negative_sentiment_spike(i: Inputs) -> DataFrame:
    return _spike_table(TR.negative_sentiment_spikes(i.rollup(), TD.FIXTURE_YEARLY_MIN_COUNT))


def top_sentiment(i: Inputs) -> DataFrame:
    return _sent_table(TR.top_sentiment(i.rollup(), TD.FIXTURE_YEARLY_MIN_COUNT))


def bottom_sentiment(i: Inputs) -> DataFrame:
    return _sent_table(TR.bottom_sentiment(i.rollup(), TD.FIXTURE_YEARLY_MIN_COUNT))


# --- reads --------------------------------------------------------------------------------

def _series(i: Inputs) -> DataFrame:
    return X.word_explorer(i.words(), i.definitions(), TD.FIXTURE_LOOKUP)


def word_explorer(i: Inputs) -> DataFrame:
    return _fact_out(_series(i))


def word_summary(i: Inputs) -> DataFrame:
    s = X.word_summary(_series(i), i.definitions())
    return s.select("word", "total_count", _r("avg_avg_sentiment"), "definition", "concise_definition")


def word_summary_display(i: Inputs) -> DataFrame:
    return X.word_summary_display(X.word_summary(_series(i), i.definitions()))


def fact_lookup(i: Inputs) -> DataFrame:
    """The facts of the looked-up words out of a written, range-clustered fact table."""
    path = f"{ensure_checkpoint_dir(i.spark)}/facts-{uuid.uuid4().hex}"
    SK.write_monthly(i.words(), path)
    return SK.read_words(i.spark, path, X.parse_words(TD.FIXTURE_LOOKUP), schemas.WORDS)


def words_not_found(i: Inputs) -> DataFrame:
    return X.words_not_found(i.words(), i.definitions(), TD.FIXTURE_LOOKUP)


def _yearly_out(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        "year", "neg_word", _r("negative_sentiment_spike"), "pos_word", _r("positive_sentiment_spike"),
        "top_spike", _r("top_frequency_spike"), "top_sentiment_word", _r("top_sentiment"),
        "bottom_sentiment_word", _r("bottom_sentiment"), "bottom_spike", _r("bottom_frequency_spike"),
        "rank", *more)


def yearly_words(i: Inputs) -> DataFrame:
    return _yearly_out(X.yearly_words(i.trends(), TD.FIXTURE_YEAR))


def yearly_by_position(i: Inputs) -> DataFrame:
    return _yearly_out(X.yearly_by_position(i.trends(), TD.FIXTURE_YEAR), "position")


def trend_top10(i: Inputs) -> DataFrame:
    top = X.trend_top10(i.trends(), TD.FIXTURE_YEAR)
    spike = F.col("chart").contains("frequency")
    return top.withColumn("score", F.when(spike, TR.to_digits(F.col("score"), F.abs("score"), SPIKE_DIGITS))
                          .otherwise(F.round("score", ROUND)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "comments_scan": _q(comments_scan),
    "month_range_scan": _q(month_range_scan),
    "row_count": _q(row_count),
    "tokenize": _q(tokenize),
    "parse_word_list": _q(parse_word_list_q),
    "concise_definition": _q(concise_definition_q),
    "censor_words": _q(censor_words),
    "word_counts": _q(word_counts),
    "word_frequencies": _q(word_frequencies),
    "top_words": _q(top_words),
    "bigram_counts": _q(bigram_counts),
    "trigram_counts": _q(trigram_counts),
    "word_bank": _q(word_bank),
    "definitions": _q(definitions),
    "matched_tokens": _q(matched_tokens),
    "matched_comments": _q(matched_comments),
    "remove_stopwords": _q(remove_stopwords),
    "lexicon_sentiment": _q(lexicon_sentiment),
    "sample_to_target": _q(sample_to_target),
    "word_sentiment": _q(word_sentiment),
    "words_fact": _q(words_fact),
    "words_key_check": _q(words_key_check),
    "append_new_words": _q(append_new_words),
    "distinct_words": _q(distinct_words),
    "densify_months": _q(densify_months),
    "yearly_frequency": _q(yearly_frequency),
    "yearly_sentiment": _q(yearly_sentiment),
    "frequency_spike": _q(frequency_spike),
    "sentiment_spike": _q(sentiment_spike),
    "top_frequency_spikes": _q(top_frequency_spikes),
    "bottom_frequency_spikes": _q(bottom_frequency_spikes),
    "positive_sentiment_spike": _q(positive_sentiment_spike),
    "negative_sentiment_spike": _q(negative_sentiment_spike),
    "top_sentiment": _q(top_sentiment),
    "bottom_sentiment": _q(bottom_sentiment),
    "word_explorer": _q(word_explorer),
    "word_summary": _q(word_summary),
    "word_summary_display": _q(word_summary_display),
    "words_not_found": _q(words_not_found),
    "yearly_words": _q(yearly_words),
    "yearly_by_position": _q(yearly_by_position),
    "trend_top10": _q(trend_top10),
    "fact_lookup": _q(fact_lookup),
}
