"""Fact table, zero-fill and the yearly tables on hand-made rows (K9-K17)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lexitrend.operators import bank as B
from lexitrend.operators import explore as X
from lexitrend.operators import fact as FT
from lexitrend.operators import trends as TR
from lexitrend.schemas import WORDS


def d(y, m=1):
    return dt.date(y, m, 1)


@pytest.fixture
def words(spark):
    rows = [
        # word a: years 2010, 2012, 2013 (2011 missing -> lag/lead skip it)
        ("a", d(2010), 10, 0.1, 0.5, None), ("a", d(2010, 2), 10, 0.3, 0.1, 0.2),
        ("a", d(2012), 30, 0.4, 0.2, 0.1), ("a", d(2013), 30, 0.1, -0.2, 0.1),
        # word b: 2011 is under the threshold of 25
        ("b", d(2010), 50, 0.2, 0.3, 0.0), ("b", d(2011), 5, 0.2, 0.9, 0.0),
        ("b", d(2012), 50, 0.2, 0.1, 0.0), ("b", d(2013), 50, 0.2, 0.4, 0.0),
        # c ties with d in 2012
        ("c", d(2011), 40, 0.1, 0.0, 0.0), ("c", d(2012), 40, 0.5, 0.6, 0.0), ("c", d(2013), 40, 0.1, 0.0, 0.0),
        ("e", d(2011), 40, 0.1, 0.0, 0.0), ("e", d(2012), 40, 0.5, 0.6, 0.0), ("e", d(2013), 40, 0.1, 0.0, 0.0),
    ]
    return spark.createDataFrame(rows, WORDS)


def test_rollup_is_unweighted(words):
    r = {(x["word"], x["year"]): x for x in TR.yearly_rollup(words).collect()}
    assert r[("a", d(2010))]["yearly_count"] == 20
    assert r[("a", d(2010))]["avg_frequency"] == pytest.approx(0.2)
    assert r[("a", d(2010))]["avg_sentiment"] == pytest.approx(0.3)


def test_spike_skips_gap_years(words):
    r = {(x["word"], x["year"]): x["frequency_spike"]
         for x in TR.frequency_spikes(TR.yearly_rollup(words)).collect()}
    assert r[("a", d(2010))] is None and r[("a", d(2013))] is None
    # 2012's neighbours are 2010 (0.2) and 2013 (0.1): 2*0.4 - 0.2 - 0.1
    assert r[("a", d(2012))] == pytest.approx(0.5)


def test_threshold_before_window(words):
    r = {(x["word"], x["year"]): x["sentiment_spike_year"]
         for x in TR.sentiment_spikes(TR.yearly_rollup(words), min_count=25).collect()}
    assert ("b", d(2011)) not in r
    # b 2012 neighbours are 2010 and 2013 (2011 was filtered out first)
    assert r[("b", d(2012))] == pytest.approx(2 * 0.1 - 0.3 - 0.4)


def test_rank_ties_share_rank(words):
    top = TR.top_frequency_spikes(TR.yearly_rollup(words), k=1).filter(F.col("year") == d(2012))
    got = sorted((x["word"], x["rank"]) for x in top.collect())
    assert got == [("c", 1), ("e", 1)]


def test_yearly_words_join_drops_missing_ranks_and_multiplies_ties(spark):
    def t(rows, cols):
        return spark.createDataFrame(rows, cols)
    y = d(2012)
    fs = "word string, year date, yearly_count long, avg_frequency double, frequency_spike double, rank long"
    ss = "word string, year date, yearly_count long, sentiment_spike_year double, rank long"
    ts = "word string, year date, avg_sentiment double, rank long"
    trends = {
        "top_frequency_spikes": t([("a", y, 1, 0.1, 0.5, 1), ("b", y, 1, 0.1, 0.5, 1), ("c", y, 1, 0.1, 0.4, 2)], fs),
        "bottom_frequency_spikes": t([("d", y, 1, 0.1, -0.5, 1), ("e", y, 1, 0.1, -0.4, 2)], fs),
        "positive_sentiment_spikes": t([("f", y, 1, 0.3, 1), ("g", y, 1, 0.2, 2)], ss),
        "negative_sentiment_spikes": t([("h", y, 1, -0.3, 1), ("i", y, 1, -0.2, 2)], ss),
        "top_sentiment": t([("j", y, 0.9, 1), ("k", y, 0.8, 2)], ts),
        "bottom_sentiment": t([("l", y, -0.9, 1)], ts),
    }
    out = X.yearly_words(trends, 2012).collect()
    assert len(out) == 2 and {r["top_spike"] for r in out} == {"a", "b"}
    assert all(r["rank"] == 1 for r in out)


def test_densify_grid(words):
    full = FT.densify(words, "2010-01-01", "2013-12-01")
    assert full.select("word", "year_month").distinct().count() == 4 * 48
    assert full.count() == 4 * 48
    z = full.filter((F.col("word") == "a") & (F.col("year_month") == d(2011))).first()
    assert z["count"] == 0 and z["avg_sentiment"] == 0.0


def test_key_check_and_append(words, spark):
    assert FT.key_duplicates(words).first()["duplicate_keys"] == 0
    dup = words.unionByName(words.limit(1))
    assert FT.key_duplicates(dup).first()["duplicate_keys"] == 1
    old = words.filter(F.col("year_month") < d(2012))
    new = words.filter(F.col("year_month") >= d(2011))
    added = FT.append_new_words(new, old)
    assert added.filter(F.col("year_month") < d(2012)).count() == 0
    assert added.count() == words.filter(F.col("year_month") >= d(2012)).count()


def test_definitions_tiebreak(spark):
    rows = [("LOL", "laugh. b", 5), ("lol", "aaa. x", 5), ("lol", "zzz", 3), ("two words", "x", 9),
            ("  yo ", "greeting", None), ("yo", "hey", 1), ("", "blank", 4)]
    d_ = {r["word"]: r["definition"] for r in
          B.definitions(spark.createDataFrame(rows, "word string, definition string, up_votes long")).collect()}
    assert d_ == {"lol": "aaa. x", "yo": "hey"}


def test_word_bank_rules(spark):
    src = spark.createDataFrame([("Don't",), ("two words",), ("The",), ("yeet",), ("yeet",)], "word string")
    stop = spark.createDataFrame([("THE",)], "word string")
    assert sorted(r[0] for r in B.word_bank(src, stop).collect()) == ["don't", "yeet"]


def test_word_explorer_fills_zero_months(words, spark):
    defs = spark.createDataFrame([("a", "letter a. first"), ("zz", "nothing")], "word string, definition string")
    series = X.word_explorer(words, defs, "A, b, zz,", "2010-01-01", "2010-12-01")
    rows = series.collect()
    assert {r["word"] for r in rows} == {"a"}
    # 10 zero months of 2010 plus all 4 fact rows (facts outside the calendar stay in)
    assert len(rows) == 14 and all(r["stddev_sentiment"] is not None for r in rows)
    summ = X.word_summary(series, defs).first()
    assert summ["total_count"] == 80
    assert summ["avg_avg_sentiment"] == pytest.approx(0.6 / 14)
    assert summ["concise_definition"] == "letter a"
    missing = sorted(r[0] for r in X.words_not_found(words, defs, "A, b, zz,").collect())
    assert missing == ["b", "zz"]


def test_small_frequencies_are_ranked_apart(spark):
    """Spikes of the order 1e-14 in steps of 2e-14: 100 words, ranks 1 to 100."""
    rows = [(f"w{i:03}", d(y), 10, 1e-12 + (i * 1e-14 if y == 2011 else 0.0), 0.0, 0.0)
            for i in range(300) for y in (2010, 2011, 2012)]
    top = TR.top_frequency_spikes(TR.yearly_rollup(spark.createDataFrame(rows, WORDS))).collect()
    assert sorted((r["rank"], r["word"]) for r in top) == [(k, f"w{300 - k:03}") for k in range(1, 101)]


def test_trend_top10_shows_tied_words_each_once(spark):
    rows = [(f"w{i}", d(y), 50, 0.1 if y != 2011 else 0.2, 0.1 if y != 2011 else 0.3, 0.0)
            for i in range(4) for y in (2010, 2011, 2012)]
    trends = TR.yearly_trends(TR.yearly_rollup(spark.createDataFrame(rows, WORDS)), min_count=10)
    got = X.trend_top10(trends, 2011).collect()
    assert len(got) == 6 * 4
    for chart in {r["chart"] for r in got}:
        own = sorted((r["position"], r["word"]) for r in got if r["chart"] == chart)
        assert own == [(1, "w0"), (2, "w1"), (3, "w2"), (4, "w3")]


def test_large_dimensions_join_by_salted_shuffle(spark):
    from lexitrend.operators import broadcast as BR
    from lexitrend.operators import frequency as FQ

    comments = spark.createDataFrame([(1, "a b b c"), (2, None), (None, "b d"), (1, "")], "doc_id long, body string") \
        .withColumn("year_month", F.to_date(F.lit("2010-01-01")))
    bank = spark.createDataFrame([("b",), ("c",), (None,)], "word string")

    def results():
        return [sorted(map(str, df.collect())) for df in (
            B.matched_tokens(comments, bank), FQ.monthly_ngrams_of(comments, bank),
            B.remove_stopwords(FQ.word_counts(comments), bank),
            BR.join_dimension(comments, spark.createDataFrame([("b d", 7)], "body string, x int"), "body", "left"))]

    small = results()
    spark.conf.set(BR.MAX_BYTES_CONF, "0")
    try:
        assert results() == small                       # behind a Bloom filter
        spark.conf.set(BR.BLOOM_BYTES_CONF, "0")        # and without one: nothing is broadcast
        assert "BroadcastExchange" not in B.matched_tokens(comments, bank)._jdf.queryExecution().executedPlan().toString()
        assert results() == small
    finally:
        spark.conf.unset(BR.MAX_BYTES_CONF)
        spark.conf.unset(BR.BLOOM_BYTES_CONF)


def test_bloom_filter_drops_sure_misses_only(spark):
    from lexitrend.operators import broadcast as BR

    keys = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("word"))
    rows = spark.range(200_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("word")).unionByName(
        spark.createDataFrame([(None,)], "word string"))
    dim = BR.dimension(keys)
    left = BR.without_sure_misses(rows, dim, "word", 1 << 20)
    assert left.join(keys, "word", "left_semi").count() == 20_000            # no hit is lost
    assert left.count() <= 1.1 * 20_000                                      # what a join has to move
    assert BR.without_sure_misses(rows, dim, "word", 0) is rows              # a filter past its limit is not made
    spark.conf.set(BR.MAX_BYTES_CONF, "0")
    try:
        joined = BR.join_dimension(rows, dim, "word", "left_semi")
        assert joined.count() == 20_000
        some = BR.join_dimension(rows, BR.dimension(keys.withColumn("x", F.lit(1))), "word", "left",
                                 wanted=F.col("word") == "k199999")
        assert some.filter("x = 1").count() == 20_000 and some.filter("word = 'k199999'").count() == 1
    finally:
        spark.conf.unset(BR.MAX_BYTES_CONF)


def test_tied_words_stand_below_each_other(spark):
    """Four tied words in each of the six tables: four rows by position, the product in the flat form."""
    y = d(2012)
    trends = {}
    for k, (name, metric, _) in enumerate(X.YEARLY_READ.values()):
        rows = [(f"{name}{j}", y, 0.5, 1) for j in range(4)] + ([("late", y, 0.1, 5)] if k == 0 else [])
        trends[name] = spark.createDataFrame(rows, f"word string, year date, {metric} double, rank long")
    by = X.yearly_by_position(trends, 2012).collect()
    assert sorted((r["rank"], r["position"]) for r in by) == [(1, 1), (1, 2), (1, 3), (1, 4), (5, 1)]
    first = next(r for r in by if r["rank"] == 1 and r["position"] == 3)
    assert first["top_spike"] == "top_frequency_spikes2" and first["neg_word"] == "negative_sentiment_spikes2"
    last = next(r for r in by if r["rank"] == 5)
    assert last["neg_word"] == "late" and last["top_spike"] is None
    assert X.yearly_words(trends, 2012).count() == 4 ** 6
    assert X.yearly_words(trends, 2011).count() == 0 and X.yearly_by_position(trends, 2011).count() == 0


def test_yearly_words_year_choice():
    from lexitrend import constants as C

    with pytest.raises(ValueError):
        X.yearly_words({}, 2010, allowed_years=C.YEARLY_READ_YEARS)
