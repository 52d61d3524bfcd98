"""Plan shape: broadcast semi-join, per-year group limit, no Python in any plan."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bank_match_is_broadcast_semi_join(spark):
    p = _plan(E.queries()["matched_tokens"](spark, SF))
    assert "BroadcastHashJoin" in p and "LeftSemi" in p


def test_rank_filter_becomes_group_limit(spark):
    df = E.queries()["top_frequency_spikes"](spark, SF)
    assert "WindowGroupLimit" in df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["word_frequencies", "word_sentiment", "lexicon_sentiment",
                                  "densify_months", "yearly_words"])
def test_no_python_in_plan(spark, name):
    from lexitrend.plans.catalog import plans_of

    for p in plans_of(spark, SF, name).values():
        assert "PythonUDF" not in p and "ArrowEvalPython" not in p and "BatchEvalPython" not in p


def test_facts_read_and_tokenise_the_comments_once(spark):
    """The checkpointed stage is looked at too: one scan of the texts, one vocabulary broadcast."""
    from lexitrend.plans.catalog import plans_of

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")    # leaves the hinted broadcasts
    try:
        stage = plans_of(spark, SF, "words_fact")["words"]
        # The facts and the month totals come out of one aggregate (one exchange, used twice).
        assert stage.count("BroadcastExchange") in (2, 3) and "Scan parquet" in stage
        assert _plan(E.queries()["lexicon_sentiment"](spark, SF)).count("BroadcastExchange") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_facts_and_totals_share_one_scoring_pass_when_run(spark):
    """The plan as it ran: the second use of the scored and counted comments is a reused exchange."""
    from lexitrend.operators import sentiment as S
    from lexitrend.sources import testdata as TD

    rows = [(1, "This at the END, no good!", "2010-01-01"), (2, None, "2010-01-01"), (3, "end of the end", "2010-02-01")]
    c = spark.createDataFrame(rows, "doc_id long, body string, m string").withColumn("year_month", TD.F.to_date("m"))
    bank = spark.createDataFrame([("end",), ("good",)], "word string")
    facts = S.monthly_word_facts(c, bank, TD.lexicon(spark), TD.boosters(spark), TD.negations(spark))
    got = sorted((str(r.year_month), r.word, r["count"], round(r.frequency, 6)) for r in facts.collect())
    assert got == [("2010-01-01", "end", 1, 0.166667), ("2010-01-01", "good", 1, 0.166667), ("2010-02-01", "end", 2, 0.5)]
    ran = _plan(facts).split("== Initial Plan ==")[0]
    assert ran.count("Generate explode") == 1 and "ReusedExchange" in ran


def test_year_filter_reaches_the_ranks(spark):
    p = E.queries()["yearly_words"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("year(year") >= 6


def test_frequency_totals_not_collected(spark):
    p = _plan(E.queries()["word_frequencies"](spark, SF))
    assert "BroadcastHashJoin" in p


def test_counts_and_totals_come_out_of_one_pass(spark):
    from lexitrend.operators import frequency as FQ
    from lexitrend.sources import testdata as TD

    rows = [(1, "a b a", "2010-01-01"), (2, None, "2010-01-01"), (3, "", "2010-02-01"), (4, "a b c", "2010-02-01"), (5, "x", "2010-03-01")]
    c = spark.createDataFrame(rows, "doc_id long, body string, m string").withColumn("year_month", TD.F.to_date("m"))
    for n in (1, 2):
        counted = FQ.counts_and_totals(TD.comments(spark, SF), n)
        assert _plan(counted).count("Generate explode") == 1
        want = FQ.with_frequency(FQ.word_counts(c, n)).collect()
        assert sorted(map(str, FQ.monthly_ngrams(c, n).collect())) == sorted(map(str, want))


def test_tokeniser_inside_generate(spark):
    p = _plan(E.queries()["word_counts"](spark, SF))
    assert "Generate explode(split(regexp_replace(lower(" in p
