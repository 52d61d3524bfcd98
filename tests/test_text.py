"""Tokenising and small text functions on hand-made rows (K1-K4, F2, F8, F9, P15)."""

from pyspark.sql import functions as F

from lexitrend.functions import censor, concise_definition, ngrams, parse_word_list, tokens


def _one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("s")).alias("r")).first()["r"]


def test_tokens_rules(spark):
    assert _one(spark, tokens, "Éa-b_C's x don't") == ["ab_cs", "x", "dont"]
    assert _one(spark, tokens, " a b ") == ["", "a", "b", ""]
    assert _one(spark, tokens, "") == [""]
    assert _one(spark, tokens, None) is None


def test_explode_null_body_gives_no_rows(spark):
    df = spark.createDataFrame([(None,), ("a b",)], "s string")
    assert df.select(F.explode(tokens("s"))).count() == 2


def test_ngrams(spark):
    toks = lambda c: ngrams(tokens(c), 2)
    assert _one(spark, toks, "a b c") == ["a b", "b c"]
    assert _one(spark, toks, "a") == []
    assert _one(spark, toks, None) is None
    tri = lambda c: ngrams(tokens(c), 3)
    assert _one(spark, tri, "a b c d") == ["a b c", "b c d"]


def test_ngram_total_property(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for n in (1, 2, 3):
        got = df.select(F.explode(ngrams(tokens("text"), n))).count()
        want = df.select(F.sum(F.greatest(F.size(tokens("text")) - (n - 1), F.lit(0)))).first()[0]
        assert got == want


def test_parse_word_list(spark):
    assert _one(spark, parse_word_list, " Die, ,eran,\tAnon ,") == ["die", "eran", "anon"]


def test_concise_definition(spark):
    assert _one(spark, concise_definition, "A thing. More. Even more") == "A thing"
    assert _one(spark, concise_definition, "Lol. Laugh out loud. x") == "Lol Laugh out loud"
    assert _one(spark, concise_definition, "no dot here") == "no dot here"
    assert _one(spark, concise_definition, "ab") == "ab"


def test_censor(spark):
    df = spark.createDataFrame([("rape", True), ("fine", False), ("x", True)], "w string, b boolean")
    got = [r[0] for r in df.select(censor("w", F.col("b"))).collect()]
    assert got == ["r***", "fine", "x"]


def test_restricted_counts_equal_full_counts(spark):
    from lexitrend.operators import frequency as FQ
    from lexitrend.sources import testdata as TD

    comments = TD.comments(spark, "/root/testdata/sf0.001")
    words = spark.createDataFrame([("the",), ("die",), ("eran",), ("",), ("nope",)], "word string")
    full = FQ.monthly_ngrams(comments).join(words, "word", "left_semi")
    part = FQ.monthly_ngrams_of(comments, words)
    cols = ["year_month", "word", "count", "frequency"]
    assert part.count() == full.count() > 0
    assert part.select(*cols).exceptAll(full.select(*cols)).count() == 0


def test_ngrams_cut_no_list_per_ngram(spark):
    """Trigrams of a long text: each is put together from its tokens (a slice per n-gram before)."""
    df = spark.createDataFrame([("a b c d",), ("",), ("a b",), (None,)], "s string").select(ngrams(tokens("s"), 3).alias("g"))
    assert [r["g"] for r in df.collect()] == [["a b c", "b c d"], [], [], None]
    assert "array_join" not in df._jdf.queryExecution().optimizedPlan().toString()
