"""Driver contract and oracle agreement on the smallest tables."""

import os
import sys

import pytest

import __spark_entry__ as E
from lexitrend.plans.catalog import QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"word", "year", "yearly_count", "avg_frequency", "frequency_spike", "rank"}


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


FAST = ["tokenize", "word_frequencies", "bigram_counts", "definitions", "lexicon_sentiment",
        "sample_to_target", "positive_sentiment_spike", "word_summary"]


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, name):
    from oracle_check import compare

    res = compare(spark, "/root/testdata/sf0.001", [name], verbose=False)[name]
    assert res[0] == "ok", res
