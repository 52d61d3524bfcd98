"""End to end: archive -> Parquet -> counts, sentiment -> fact table -> yearly tables, and the
incremental (streaming) loader adding a month later."""

import bz2
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from lexitrend.operators import bank as B
from lexitrend.operators import fact as FT
from lexitrend.operators import frequency as FQ
from lexitrend.operators import sentiment as S
from lexitrend.plans import jobs as J
from lexitrend import jobs as CLI
from lexitrend.sources import sinks as SK
from lexitrend.sources import testdata as TD
from lexitrend.streaming import monthly as M

SF = "/root/testdata/sf0.001"


def _write_archive(rows, root):
    by_month = {}
    for r in rows:
        by_month.setdefault((r["year_month"].year, r["year_month"].month), []).append(r)
    for (y, m), rs in by_month.items():
        os.makedirs(f"{root}/{y}", exist_ok=True)
        with bz2.open(f"{root}/{y}/RC_{y}-{m:02d}.bz2", "wt") as f:
            for r in rs:
                f.write(json.dumps({"id": str(r["doc_id"]), "body": r["body"],
                                    "subreddit": r["subreddit"], "score": 1}) + "\n")


@pytest.fixture(scope="module")
def setup(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("jobs")
    comments = TD.comments(spark, SF).filter(F.year("year_month") == 1996)
    rows = [r.asDict() for r in comments.collect()]
    early = [r for r in rows if r["year_month"].month <= 6]
    late = [r for r in rows if r["year_month"].month > 6]
    dict_csv = str(base / "dict.csv")
    TD.dictionary(spark, SF).toPandas().to_csv(dict_csv, index=False)
    stop = base / "stop.txt"
    stop.write_text("\n".join(TD.FIXTURE_STOPWORDS) + "\n")
    return dict(base=base, early=early, late=late, dict_csv=dict_csv, stop=str(stop), n=len(rows))


def test_batch_jobs(spark, setup):
    base = setup["base"]
    raw, pq, out = str(base / "raw"), str(base / "pq"), str(base / "out")
    _write_archive(setup["early"] + setup["late"], raw)
    J.convert_archive(spark, raw, pq)
    assert spark.read.parquet(pq).count() == setup["n"]
    J.word_freqs(spark, pq, out, ns=(1, 2))
    lex, boo, neg = TD.lexicon(spark), TD.boosters(spark), TD.negations(spark)
    J.sentiment(spark, pq, setup["dict_csv"], setup["stop"], lex, boo, neg, f"{out}/sentiment")
    J.load_words(spark, f"{out}/1_gram_counts", f"{out}/sentiment", setup["stop"], f"{out}/words")
    # same rows as the in-memory operators over the same comments
    comments = spark.read.parquet(pq).withColumn("year_month", F.make_date("year", "month", F.lit(1)))
    bank = B.word_bank(TD.dictionary(spark, SF).select("word"), TD.stopwords(spark))
    want = FT.words_fact(FQ.monthly_ngrams(comments),
                         S.monthly_word_sentiment(comments, bank, lex, boo, neg), TD.stopwords(spark))
    got = SK.read_monthly(spark, f"{out}/words")
    # no default bound: every month of the archive is there
    months = {(r["year_month"].year, r["year_month"].month) for r in setup["early"] + setup["late"]}
    assert {(r[0].year, r[0].month) for r in got.select("year_month").distinct().collect()} == months
    key = ["word", "year_month", "count"]
    assert got.count() == want.count() > 0
    assert got.select(*key).exceptAll(want.select(*key)).count() == 0
    # loading some months again changes nothing
    J.load_words(spark, f"{out}/1_gram_counts", f"{out}/sentiment", setup["stop"], f"{out}/words",
                 start="1996-02-01", end="1996-03-01")
    assert SK.read_monthly(spark, f"{out}/words").count() == want.count()
    J.yearly_tables(spark, f"{out}/words", f"{out}/yearly", min_count=1)
    tables = J.read_yearly_tables(spark, f"{out}/yearly")
    assert set(tables) == {"top_frequency_spikes", "bottom_frequency_spikes", "positive_sentiment_spikes",
                           "negative_sentiment_spikes", "top_sentiment", "bottom_sentiment"}
    assert tables["top_sentiment"].count() > 0


def test_streaming_adds_new_months(spark, setup):
    base = setup["base"]
    raw1, raw2, pq, out = (str(base / "s_raw1"), str(base / "s_raw2"), str(base / "s_pq"), str(base / "s_out"))
    _write_archive(setup["early"], raw1)
    J.convert_archive(spark, raw1, pq)
    bank = B.word_bank(TD.dictionary(spark, SF).select("word"), TD.stopwords(spark))
    inputs = M.MonthlyInputs(bank=bank, lexicon=TD.lexicon(spark), boosters=TD.boosters(spark),
                             negations=TD.negations(spark), stopwords=TD.stopwords(spark), target=None)
    ckpt = str(base / "s_ckpt")
    M.start(spark, pq, out, ckpt, inputs).awaitTermination()
    first = SK.read_monthly(spark, f"{out}/words")
    months1 = {r[0] for r in first.select("year_month").distinct().collect()}
    assert months1 and max(months1).month <= 6
    _write_archive(setup["late"], raw2)
    J.convert_archive(spark, raw2, pq)
    M.start(spark, pq, out, ckpt, inputs).awaitTermination()
    second = SK.read_monthly(spark, f"{out}/words")
    months2 = {r[0] for r in second.select("year_month").distinct().collect()}
    assert months1 < months2 and max(months2).month > 6
    assert FT.key_duplicates(second).first()["duplicate_keys"] == 0


def _tiny(spark, base, rows, name):
    raw = str(base / name)
    _write_archive([dict(doc_id=i, body=b, subreddit="x", year_month=dt.date(2014, 1, 1)) for i, b in rows], raw)
    return raw


def test_late_files_of_a_loaded_month_change_its_facts(spark, tmp_path):
    """A second file of the same month: counts, frequency and sentiment of the facts follow."""
    pq, out = str(tmp_path / "pq"), str(tmp_path / "out")
    inputs = M.MonthlyInputs(bank=spark.createDataFrame([("yolo",)], "word string"),
                             lexicon=spark.createDataFrame([("good", 2.0), ("bad", -2.0)], "word string, valence double"))
    first = [(1, "yolo good"), (2, "yolo")]
    late = [(3, "yolo bad bad"), (4, "yolo yolo bad"), (5, "other")]
    for name, rows in (("a", first), ("b", first + late)):
        J.convert_archive(spark, _tiny(spark, tmp_path, rows, name), pq)
        M.refresh_months(spark, pq, out, [dt.date(2014, 1, 1)], inputs)
        got = SK.read_monthly(spark, f"{out}/words").collect()
        texts = [b for _, b in rows]
        n = sum(b.split().count("yolo") for b in texts)
        assert [(r["word"], r["count"]) for r in got] == [("yolo", n)]
        assert got[0]["frequency"] == pytest.approx(n / sum(len(b.split()) for b in texts))
    assert got[0]["avg_sentiment"] < 0
    # a month whose comments no longer hold a bank word loses its facts
    J.convert_archive(spark, _tiny(spark, tmp_path, [(9, "nothing here")], "c"), pq)
    M.refresh_months(spark, pq, out, [dt.date(2014, 1, 1)], inputs)
    assert not os.path.exists(f"{out}/words/year=2014/month=01")
    assert os.path.exists(f"{out}/1_gram_counts/year=2014/month=01")


def test_load_words_refuses_double_keys_and_zero_fill_its_own_table(spark, tmp_path):
    from lexitrend.schemas import WORDS

    month = dt.date(2010, 1, 1)
    facts = spark.createDataFrame([("w", month, 2, 0.5, 0.1, None), ("v", dt.date(2010, 4, 1), 1, 1.0, 0.2, 0.0)], WORDS)
    counts, sent, words = (str(tmp_path / n) for n in ("counts", "sent", "words"))
    SK.write_monthly(facts.select("word", "year_month", "count", "frequency"), counts)
    SK.write_monthly(facts.select("word", "year_month", "avg_sentiment", "stddev_sentiment"), sent)
    stop = tmp_path / "stop.txt"
    stop.write_text(" The \n")
    J.load_words(spark, counts, sent, str(stop), words)
    J.zero_fill(spark, words, str(tmp_path / "full"))
    full = SK.read_monthly(spark, str(tmp_path / "full"))
    assert full.count() == 2 * 4     # the table's own calendar, January to April
    with pytest.raises(ValueError):
        J.zero_fill(spark, words, words + "/")
    SK.write_monthly(facts.unionByName(facts).select("word", "year_month", "count", "frequency"), counts)
    with pytest.raises(ValueError):
        J.load_words(spark, counts, sent, str(stop), words)
    assert SK.read_monthly(spark, words).count() == 2


def test_one_word_read_has_a_pushed_filter(spark, tmp_path):
    from lexitrend.operators import explore as X
    from lexitrend.schemas import WORDS

    rows = [(f"w{i:03}", dt.date(2010, 1, 1), 1, 0.1, 0.0, None) for i in range(300)]
    SK.write_monthly(spark.createDataFrame(rows, WORDS), str(tmp_path / "w"))
    defs = spark.createDataFrame([("w007", "x")], "word string, definition string")
    series = X.word_explorer(SK.read_monthly(spark, str(tmp_path / "w")), defs, "w007")
    plan = series._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(word,w007)" in plan or "In(word, [w007])" in plan
    assert [r["word"] for r in series.collect()] == ["w007"]


def test_command_line(spark, setup, tmp_path):
    base, out = str(tmp_path), str(tmp_path / "out")
    _write_archive(setup["early"], base + "/raw")
    lex = tmp_path / "lex.tsv"
    lex.write_text("".join(f"{r['word']}\t{r['valence']}\n" for r in TD.lexicon(spark).collect()))
    run = CLI.main
    run(["convert_archive", "--raw", base + "/raw", "--out", base + "/pq"])
    run(["word_freqs", "--comments", base + "/pq", "--out", out, "--start", "1996-02-01", "--end", "1996-03-01"])
    run(["sentiment", "--comments", base + "/pq", "--dictionary", setup["dict_csv"], "--stopwords", setup["stop"],
         "--lexicon", str(lex), "--out", out + "/sentiment", "--start", "1996-02-01"])
    run(["load_words", "--ngrams", out + "/1_gram_counts", "--sentiment", out + "/sentiment",
         "--stopwords", setup["stop"], "--out", out + "/words"])
    run(["load_definitions", "--dictionary", setup["dict_csv"], "--out", out + "/definitions"])
    run(["zero_fill", "--words", out + "/words", "--out", out + "/full"])
    run(["yearly_tables", "--words", out + "/words", "--out", out + "/yearly", "--min-count", "1", "--k", "5"])
    words = SK.read_monthly(spark, out + "/words")
    assert {r[0].month for r in words.select("year_month").distinct().collect()} == {
        r["year_month"].month for r in setup["early"]} & {2, 3}
    assert SK.read_monthly(spark, out + "/full").count() >= words.count()
    top = J.read_yearly_table(spark, out + "/yearly", "top_sentiment").collect()
    assert [(r["year"], r["rank"], r["word"]) for r in top] == sorted((r["year"], r["rank"], r["word"]) for r in top)
    with pytest.raises(SystemExit):
        run(["no_such_job"])
