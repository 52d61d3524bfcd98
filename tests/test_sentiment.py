"""Lexicon sentiment against a plain sequential implementation of the same rules."""

import math
import random
import string

import pytest
from pyspark.sql import functions as F

from lexitrend import constants as C
from lexitrend.operators import sentiment as S

LEX = {"good": 1.9, "bad": -2.5, "great": 3.1, "ok": 0.9, "sad": -2.1, "kind": 1.0}
BOOST = {"very": 0.293, "extremely": 0.293, "barely": -0.293}
NEG = {"not", "never", "nicht"}


def _strip(tok):
    s = tok.strip(string.punctuation)
    return tok if len(s) <= 2 else s


def _upper(t):
    return t.isupper()


def brute(text):
    """Sequential scorer of the rules the Spark plan implements."""
    if text is None:
        return 0.0
    toks = [_strip(t) for t in text.split()]
    low = [t.lower() for t in toks]
    n_up = sum(1 for t in toks if _upper(t))
    cap = 0 < n_up < len(toks)
    vals = []
    for i, t in enumerate(toks):
        w = low[i]
        if w in BOOST or (w == "kind" and i + 1 < len(toks) and low[i + 1] == "of"):
            vals.append(0.0)
            continue
        if w not in LEX:
            vals.append(0.0)
            continue
        v = LEX[w]
        if _upper(t) and cap:
            v = v + C.CAPS_INCREMENT if v > 0 else v - C.CAPS_INCREMENT
        for d in (1, 2, 3):
            if i >= d and low[i - d] not in LEX:
                p = low[i - d]
                s = 0.0
                if p in BOOST:
                    s = BOOST[p] * (-1 if v < 0 else 1)
                    if _upper(toks[i - d]) and cap:
                        s = s + C.CAPS_INCREMENT if v > 0 else s - C.CAPS_INCREMENT
                s *= C.DISTANCE_DAMPING[d - 1]
                v += s
                neg = p in NEG or "n't" in p
                if d == 1:
                    if neg:
                        v *= C.NEGATION_SCALAR
                elif d == 2:
                    if low[i - 2] == "never" and low[i - 1] in ("so", "this"):
                        v *= C.NEVER_SO_SCALAR
                    elif low[i - 2] == "without" and low[i - 1] == "doubt":
                        pass
                    elif neg:
                        v *= C.NEGATION_SCALAR
                else:
                    if low[i - 3] == "never" and (low[i - 2] in ("so", "this") or low[i - 1] in ("so", "this")):
                        v *= C.NEVER_SO_SCALAR
                    elif low[i - 3] == "without" and ("doubt" in (low[i - 2], low[i - 1])):
                        pass
                    elif neg:
                        v *= C.NEGATION_SCALAR
        if i > 1 and low[i - 1] not in LEX and low[i - 1] == "least":
            if low[i - 2] not in ("at", "very"):
                v *= C.NEGATION_SCALAR
        elif i > 0 and low[i - 1] not in LEX and low[i - 1] == "least":
            v *= C.NEGATION_SCALAR
        vals.append(v)
    if "but" in low:
        bi = low.index("but")
        vals = [v * C.BUT_BEFORE if k < bi else v * C.BUT_AFTER if k > bi else v for k, v in enumerate(vals)]
    s = round(sum(vals), 10)
    ex = min(text.count("!"), C.EXCLAMATION_MAX) * C.EXCLAMATION_WEIGHT
    q = text.count("?")
    qa = 0.0 if q <= 1 else (q * C.QUESTION_WEIGHT if q <= 3 else C.QUESTION_MAX_WEIGHT)
    amp = ex + qa
    if s > 0:
        s += amp
    elif s < 0:
        s -= amp
    c = s / math.sqrt(s * s + C.NORMALIZE_ALPHA)
    return round(max(-1.0, min(1.0, c)), 4)


SENTENCES = [
    "The movie was good.",
    "The movie was very good!!",
    "The movie was VERY GOOD but the end was bad",
    "not good at all",
    "It is never so good",
    "it was not very bad ???",
    "at least good",
    "least good",
    "kind of good",
    "a kind man",
    "good good BAD sad!",
    "Without doubt good",
    "isn't good",
    ":) ok",
    "barely ok",
    "",
    None,
    "   spaced   out   good   ",
    "GOOD BAD GREAT",
    "nicht good, nicht bad?",
    "great but not great but bad",
]


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(i, s) for i, s in enumerate(SENTENCES)]
    comments = spark.createDataFrame(rows, "doc_id long, body string").withColumn(
        "year_month", F.to_date(F.lit("2010-01-01")))
    lex = spark.createDataFrame(list(LEX.items()), "word string, valence double")
    boo = spark.createDataFrame(list(BOOST.items()), "word string, scalar double")
    neg = spark.createDataFrame([(w,) for w in NEG], "word string")
    out = S.lexicon_sentiment(comments, lex, boo, neg)
    return {r["doc_id"]: r["compound"] for r in out.collect()}


def test_matches_sequential_rules(scored):
    for i, s in enumerate(SENTENCES):
        assert scored[i] == pytest.approx(brute(s), abs=1e-9), (s, scored[i], brute(s))


def test_every_comment_scored_and_bounded(scored):
    assert len(scored) == len(SENTENCES)
    assert all(-1.0 <= v <= 1.0 for v in scored.values())


def test_rules_have_effect(scored):
    base = brute("The movie was good.")
    assert scored[1] > base          # booster and "!"
    assert scored[3] < 0             # negation flips
    assert scored[8] == brute("good")   # "kind" of "kind of" is not scored, "good" is
    assert scored[9] > 0                # a lone "kind" is


def _comments(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, body string").withColumn(
        "year_month", F.to_date(F.lit("2010-01-01")))


def test_repeated_and_null_ids_are_scored_row_by_row(spark):
    rows = [(1, "good"), (1, "bad bad"), (None, "great yay"), (None, "sad"), (None, "sad")]
    lex = spark.createDataFrame(list(LEX.items()), "word string, valence double")
    got = S.lexicon_sentiment(_comments(spark, rows), lex).collect()
    assert sorted(r["compound"] for r in got) == pytest.approx(sorted(brute(b) for _, b in rows))
    assert sorted(str(r["doc_id"]) for r in got) == ["1", "1", "None", "None", "None"]
    word = S.monthly_word_sentiment(_comments(spark, rows), spark.createDataFrame([("sad",)], "word string"), lex).first()
    assert word["avg_sentiment"] == pytest.approx(brute("sad"))


def test_random_texts_match_sequential_rules(spark):
    import random

    rng = random.Random(3)
    pool = [*LEX, *BOOST, *NEG, "but", "so", "this", "least", "at", "without", "doubt", "of", "don't", "x", "y", "GOOD", "BAD!", "Very"]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randrange(1, 14))) for _ in range(400)]
    lex = spark.createDataFrame(list(LEX.items()), "word string, valence double")
    boo = spark.createDataFrame(list(BOOST.items()), "word string, scalar double")
    neg = spark.createDataFrame([(w,) for w in NEG], "word string")
    got = {r["doc_id"]: r["compound"] for r in S.lexicon_sentiment(
        _comments(spark, list(enumerate(texts))), lex, boo, neg).collect()}
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(brute(t), abs=1e-9), t


def test_idioms(spark):
    lex = spark.createDataFrame([("bomb", -2.0), ("good", 1.9)], "word string, valence double")
    idioms = spark.createDataFrame([("the bomb", 3.0), ("good grief now", -1.0)], "phrase string, valence double")
    texts = ["this show is the bomb", "it was a bomb", "well well well good grief now", "well well well good grief"]

    def c(v):
        return round(v / math.sqrt(v * v + C.NORMALIZE_ALPHA), 4)

    got = {r["doc_id"]: r["compound"] for r in S.lexicon_sentiment(
        _comments(spark, list(enumerate(texts))), lex, idioms=idioms).collect()}
    assert [got[i] for i in range(4)] == pytest.approx([c(3.0), c(-2.0), c(-1.0), c(1.9)])


def test_a_hundred_thousand_idioms(spark):
    """No cap: phrases are looked up in a table. The same scores with a shuffled table, and as the
    sequential rule gives them: begin at the token (longest first), end at it, or one place before."""
    import random

    from lexitrend.operators import broadcast as BR

    rng = random.Random(5)
    pool = [f"q{i}" for i in range(60)] + ["good", "bomb"]
    phrases = {}
    while len(phrases) < 3000:
        phrases[" ".join(rng.choice(pool) for _ in range(rng.randint(2, 3)))] = rng.choice([-3.0, -1.0, 2.0, 3.5])
    many = [*phrases.items(), *((f"z{i} z{i + 1}", 1.0) for i in range(97_000))]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randint(1, 12))) for _ in range(300)]
    values = {"good": 1.9, "bomb": -2.0}

    def brute_idioms(text):
        w = text.split()
        total = 0.0
        for i, t in enumerate(w):
            if t not in values:
                continue
            v = values[t]
            if i >= 3 and w[i - 3] not in values:
                at = [(i, i + 3), (i, i + 2), (i - 1, i + 1), (i - 2, i + 1), (i - 2, i), (i - 3, i), (i - 3, i - 1)]
                found = [phrases[" ".join(w[a:b])] for a, b in at if b <= len(w) and " ".join(w[a:b]) in phrases]
                v = found[0] if found else v
            total += v
        return round(total / math.sqrt(total * total + C.NORMALIZE_ALPHA), 4)

    lex = spark.createDataFrame(list(values.items()), "word string, valence double")
    idioms = spark.createDataFrame(many, "phrase string, valence double")

    def run():
        return {r["doc_id"]: r["compound"] for r in S.lexicon_sentiment(
            _comments(spark, list(enumerate(texts))), lex, idioms=idioms).collect()}

    got = run()
    assert [got[i] for i in range(len(texts))] == pytest.approx([brute_idioms(t) for t in texts])
    spark.conf.set(BR.MAX_BYTES_CONF, "0")
    try:
        assert run() == got
    finally:
        spark.conf.unset(BR.MAX_BYTES_CONF)


def test_single_characters_can_be_left_out_of_distances(spark):
    lex = spark.createDataFrame([("good", 1.9)], "word string, valence double")
    neg = spark.createDataFrame([("not",)], "word string")
    texts = [(1, "not a b c good")]
    far = S.lexicon_sentiment(_comments(spark, texts), lex, negations=neg).first()["compound"]
    near = S.lexicon_sentiment(_comments(spark, texts), lex, negations=neg, drop_single_chars=True).first()["compound"]
    assert far > 0 > near


def test_one_pass_facts_equal_the_joined_operators(spark):
    from lexitrend.operators import fact as FT
    from lexitrend.operators import frequency as FQ

    rows = [(1, "good yay yay"), (None, "bad yay solo"), (3, ""), (4, None), (4, "x y z")]
    lex = spark.createDataFrame(list(LEX.items()), "word string, valence double")
    bank = spark.createDataFrame([("yay",), ("solo",), ("never-seen",)], "word string")
    c = _comments(spark, rows)
    want = FT.words_fact(FQ.monthly_ngrams_of(c, bank), S.monthly_word_sentiment(c, bank, lex)).collect()
    got = S.monthly_word_facts(c, bank, lex).select(*FT.FACT_COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str) and len(got) == 2


def test_word_sentiment_counts_repeats(spark):
    """A bank word used three times adds its comment's score three times (K6)."""
    comments = spark.createDataFrame(
        [(1, "good yay yay yay"), (2, "bad yay"), (3, "solo")], "doc_id long, body string"
    ).withColumn("year_month", F.to_date(F.lit("2010-01-01")))
    bank = spark.createDataFrame([("yay",), ("solo",)], "word string")
    lex = spark.createDataFrame([("good", 1.9), ("bad", -2.5)], "word string, valence double")
    out = {r["word"]: r for r in S.monthly_word_sentiment(comments, bank, lex).collect()}
    g, b = brute("good yay yay yay"), brute("bad yay")
    assert out["yay"]["avg_sentiment"] == pytest.approx((3 * g + b) / 4)
    assert out["solo"]["stddev_sentiment"] is None   # one observation
    assert out["solo"]["avg_sentiment"] == 0.0


def test_custom_scorer(spark):
    comments = spark.createDataFrame([(1, "yay one"), (2, "yay two")], "doc_id long, body string") \
        .withColumn("year_month", F.to_date(F.lit("2010-01-01")))
    bank = spark.createDataFrame([("yay",)], "word string")
    out = S.monthly_word_sentiment(comments, bank, scorer=lambda b: F.length(b).cast("double"))
    r = out.first()
    assert r["avg_sentiment"] == 7.0


def test_sample_is_repeatable_and_bounded(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(
        "doc_id", F.to_date(F.lit("2010-01-01")).alias("year_month"))
    a = S.sample_to_target(df, 100, seed=7)
    b = S.sample_to_target(df, 100, seed=7)
    ids_a = sorted(r[0] for r in a.select("doc_id").collect())
    assert ids_a == sorted(r[0] for r in b.select("doc_id").collect())
    assert 50 < len(ids_a) < 160
    assert S.sample_to_target(df, 10_000).count() == df.count()
    none = spark.createDataFrame([(None, f"t{i}") for i in range(400)], "doc_id long, body string").withColumn(
        "year_month", F.to_date(F.lit("2010-01-01")))
    assert 60 < S.sample_to_target(none, 100).count() < 150     # rows without a key draw one by one


def test_moments_do_not_depend_on_partitioning(spark):
    """Bit for bit the same averages and deviations at 1, 7 and 64 partitions, and merged in parts."""
    from lexitrend.sources import testdata as TD

    sf = "/root/testdata/sf0.001"
    comments = TD.comments(spark, sf).cache()
    bank = TD.bank_source(spark, sf)
    args = (bank, TD.lexicon(spark), TD.boosters(spark), TD.negations(spark))
    got = []
    for n in (1, 7, 64):
        rows = S.monthly_word_sentiment(comments.repartition(n), *args).collect()
        got.append({(r["year_month"], r["word"]): (r["avg_sentiment"], r["stddev_sentiment"]) for r in rows})
    assert got[0] and got[0] == got[1] == got[2]
    halves = [S.monthly_word_moments(comments.filter(F.col("doc_id") % 2 == k), *args) for k in (0, 1)]
    both = S.from_moments(S.merged(halves[0].unionByName(halves[1]), "year_month", "word")).collect()
    assert {(r["year_month"], r["word"]): (r["avg_sentiment"], r["stddev_sentiment"]) for r in both} == got[0]
    comments.unpersist()


def test_deviation_against_the_formula(spark):
    import statistics

    scores = [0.1234, -0.9999, 0.5, 0.5, 0.0, 0.3333]
    df = spark.createDataFrame([(x,) for x in scores], "x double").agg(*S.moments(S.score_units(F.col("x"))))
    r = df.select(S.average().alias("a"), S.deviation().alias("d")).first()
    assert r["a"] == pytest.approx(statistics.mean(scores), abs=1e-15)
    assert r["d"] == pytest.approx(statistics.stdev(scores), abs=1e-15)
    same = spark.range(1000).select(F.lit(0.1).alias("x")).agg(*S.moments(S.score_units(F.col("x"))))
    assert same.select(S.deviation().alias("d")).first()["d"] == 0.0
    one = spark.range(1).select(F.lit(0.1).alias("x")).agg(*S.moments(S.score_units(F.col("x"))))
    assert one.select(S.deviation().alias("d")).first()["d"] is None


def test_sentiment_tokens_strip_as_the_pattern_does(spark):
    """Odd white space, tokens of punctuation, and line ends that are not white space."""
    import re

    bodies = ["", " ", "a", " a ", "\t(hello), \u000b'x' :) :( !!! a! ab!\r\n", "abc!\u0085", "abc!\u2028 x", "\u0085!abc",
              "\u00a0abc. d\u00a0", "...abc...def...", "\u00bfabc?", "!\u2029", "abc!!\u0085\u0085", "_a_b_ ~x~ `y` a\\"]
    punct = "[!-/:-@\\[-`{-~]"

    def stripped(t):
        end = t[-1] if t[-1] in "\u0085\u2028\u2029" else ""
        s = re.sub(f"{punct}+$", "", re.sub(f"^{punct}+", "", t))
        if end:
            s = re.sub(f"{punct}+$", "", s[:-1]) + end
        return t if len(s) <= 2 else s

    df = spark.createDataFrame([(b,) for b in bodies], "b string").select("b", S.sentiment_tokens(F.col("b")).alias("t"))
    for r in df.collect():
        assert r["t"] == [stripped(t) for t in re.split("[ \t\n\u000b\f\r]+", r["b"]) if t], repr(r["b"])
    assert spark.range(1).select(S.sentiment_tokens(F.lit(None).cast("string")).alias("t")).first()["t"] is None


def test_facts_score_the_comments_once(spark, tmp_path):
    """Facts and month totals read one aggregate: its exchange is planned alike in both branches, so
    it is used twice (a pushed-down filter on the word made two different ones before)."""
    spark.createDataFrame([(k, "good bank the x", "2010-01-01") for k in range(20)], "doc_id long, body string, m string").select(
        "doc_id", "body", F.to_date("m").alias("year_month")).write.parquet(str(tmp_path / "c"))
    c = spark.read.parquet(str(tmp_path / "c"))
    lex = spark.createDataFrame([("good", 1.9)], "word string, valence double")
    facts = S.monthly_word_facts(c, spark.createDataFrame([("bank",)], "word string"), lex)
    assert [(r["word"], r["count"], r["frequency"]) for r in facts.collect()] == [("bank", 20, 0.25)]
    assert "ReusedExchange" in facts._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_window_sees_no_bank_words(spark):
    """Only tokens with a role in scoring go through the window; bank words wait in the marker row."""
    c = spark.createDataFrame([(1, "bank bank good bank not bank", "2010-01-01")], "doc_id long, body string, m string").select(
        "doc_id", "body", F.to_date("m").alias("year_month"))
    vocab = S.vocabulary(spark.createDataFrame([("good", 1.9)], "word string, valence double"), None,
                         spark.createDataFrame([("not",)], "word string"), spark.createDataFrame([("bank",)], "word string"))
    rows = S._gathered(S._hits(c, vocab, "doc_id", "body", True, False)).collect()
    assert sorted((r["i"], r["word"]) for r in rows if r["i"]) == [(3, "good"), (5, "not")]
    assert [r["meta"]["matched"] for r in rows if not r["i"]] == [["bank"] * 4]



def test_scores_in_the_row_are_those_of_the_joins(spark):
    """Short lists are looked up in a comment's row, without a shuffle of its tokens; long ones by joins.
    Both give the same scores, rule words, capitals, odd tokens and NULLs included."""
    words = ["good", "GOOD", "bad", "Bad,", "very", "VERY", "not", "isn't", "GOODN'T", "but", "never", "so", "this", "least", "at",
             "without", "doubt", "kind", "of", "of,", "ok", ":)", "bank", "x", "...", "!!", "g-o", "café", "bad\u0085", "a", "mid", "of"]
    rng = random.Random(7)
    bodies = [" ".join(rng.choices(words, k=rng.randint(0, 14))) + rng.choice(["", "!", "???", " \n"]) for _ in range(400)]
    bodies += [None, "", " ", "BUT good", "least good", "at least good", "never so good", "without x doubt good"]
    c = spark.createDataFrame([(None if k % 9 == 0 else k % 5, b, f"2010-0{k % 3 + 1}-01") for k, b in enumerate(bodies)],
                              "doc_id long, body string, m string").withColumn("year_month", F.to_date("m"))
    lex = spark.createDataFrame([("good", 1.9), ("bad", -2.5), ("ok", 0.9), (":)", 2.0), ("kind", 2.4), ("café", 0.3), ("goodn't", 1.0)],
                                "word string, valence double")
    boost = spark.createDataFrame([("very", 0.293), ("mid", -0.293), ("bad", 0.1)], "word string, scalar double")
    neg = spark.createDataFrame([("not",), ("never",), ("without",)], "word string")
    bank = spark.createDataFrame([("good",), ("bank",), ("x",), ("bank",), (None,), ("",)], "word string")
    found = []
    for size in (S.DEFAULT_INLINE_BYTES, 0):
        spark.conf.set(S.INLINE_BYTES_CONF, str(size))
        try:
            facts = S.monthly_word_facts(c, bank, lex, boost, neg)
            assert ("Window" in facts._jdf.queryExecution().optimizedPlan().toString()) == (size == 0)
            found.append(sorted(map(str, facts.collect())))
        finally:
            spark.conf.unset(S.INLINE_BYTES_CONF)
    assert found[0] == found[1] and found[0]
