"""Sources and sinks: JSON archive, Parquet layout, word lists, dictionary CSV, appends."""

import bz2
import datetime as dt
import json
import os

from pyspark.sql import functions as F

from lexitrend.operators import fact as FT
from lexitrend.schemas import WORDS
from lexitrend.sources import comments as SC
from lexitrend.sources import lists as L
from lexitrend.sources import sinks as SK


def _archive(root):
    for (y, m, rows) in [(2007, 10, [{"id": "a1", "body": "Hello world", "subreddit": "x", "score": 1}]),
                         (2007, 11, [{"id": "b1", "body": "Bye", "subreddit": "y", "score": 2},
                                     {"id": "b2", "body": None, "subreddit": "y", "score": 0}])]:
        os.makedirs(f"{root}/{y}", exist_ok=True)
        with bz2.open(f"{root}/{y}/RC_{y}-{m:02d}.bz2", "wt") as f:
            for r in rows:
                f.write(json.dumps(r) + "\n")
            f.write("{not json\n")


def test_archive_roundtrip(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "pq")
    _archive(raw)
    found = sorted((r["year"], r["month"]) for r in SC.archive_months(spark, raw).collect())
    assert found == [(2007, 10), (2007, 11)]
    df = SC.read_archive(spark, raw)
    assert df.count() == 3
    SC.write_comment_parquet(df, out)
    assert sorted(os.listdir(out + "/year=2007")) == ["month=10", "month=11"]
    back = SC.read_comment_parquet(spark, out, start="2007-11-01")
    rows = back.collect()
    assert {r["doc_id"] for r in rows} == {"b1", "b2"}
    assert all(r["year_month"] == dt.date(2007, 11, 1) for r in rows)
    # a re-run of one month replaces only that month
    SC.write_comment_parquet(df.filter(F.col("month") == 10).withColumn("body", F.lit("again")), out)
    again = SC.read_comment_parquet(spark, out)
    assert again.filter(F.col("body") == "again").count() == 1
    assert again.count() == 3


def test_partition_pruning_in_plan(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "pq")
    _archive(raw)
    SC.write_comment_parquet(SC.read_archive(spark, raw), out)
    plan = SC.read_comment_parquet(spark, out, start="2007-11-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "year" in plan


def test_monthly_result_roundtrip(spark, tmp_path):
    rows = [("w", dt.date(2010, 1, 1), 2, 0.5, 0.1, None), ("v", dt.date(2010, 2, 1), 1, 1.0, 0.2, 0.0)]
    df = spark.createDataFrame(rows, WORDS)
    path = str(tmp_path / "m")
    SK.write_monthly(df, path)
    assert sorted(os.listdir(path + "/year=2010")) == ["month=01", "month=02"]
    back = SK.read_monthly(spark, path)
    assert sorted(r["word"] for r in back.collect()) == ["v", "w"]


def test_append_new_skips_present_keys(spark, tmp_path):
    path = str(tmp_path / "words")
    a = spark.createDataFrame([("w", dt.date(2010, 1, 1), 2, 0.5, 0.1, None)], WORDS)
    b = spark.createDataFrame([("w", dt.date(2010, 1, 1), 9, 0.9, 0.9, None),
                               ("w", dt.date(2010, 2, 1), 3, 0.3, 0.3, None)], WORDS)
    SK.append_new(a, spark.createDataFrame([], WORDS), ("word", "year_month"), path)
    SK.append_new(b, spark.read.parquet(path), ("word", "year_month"), path)
    t = spark.read.parquet(path)
    assert t.count() == 2
    assert FT.key_duplicates(t).first()["duplicate_keys"] == 0
    assert t.filter(F.col("year_month") == dt.date(2010, 1, 1)).first()["count"] == 2


def test_word_lists(spark, tmp_path):
    p = tmp_path / "stop.txt"
    p.write_text("The\n  of \n\nAND\nthe\n")
    assert sorted(r[0] for r in L.read_word_list(spark, str(p)).collect()) == ["and", "of", "the"]
    bad = L.bad_words(L.read_word_list(spark, str(p)))
    assert bad.filter(F.col("word") == "rape").count() == 1
    assert bad.count() == 3 + 6


def test_odd_number_fields_lose_no_comment(spark, tmp_path):
    os.makedirs(tmp_path / "raw/2010")
    lines = ['{"body": "one", "score": 1}', '{"body": "two", "score": "7"}', '{"body": "three", "score": 2.5}',
             '{"body": "four", "score": null, "ups": {"x": 1}}', "not json"]
    with bz2.open(tmp_path / "raw/2010/RC_2010-01.bz2", "wt") as f:
        f.write("\n".join(lines) + "\n")
    got = {r["body"]: r["score"] for r in SC.read_archive(spark, str(tmp_path / "raw")).collect()}
    assert set(got) == {"one", "two", "three", "four"} and got["one"] == 1 and got["two"] == 7
    report = SC.archive_report(spark, str(tmp_path / "raw")).first()
    assert (report["lines"], report["dropped"]) == (5, 1)


def test_dictionary_lines_of_wrong_length(spark, tmp_path):
    p = tmp_path / "dict.csv"
    p.write_text("word,definition,up_votes,author\nok,fine,1,a\nshort,two\nlong,x,2,b,c,d\n")
    every = {r["word"]: r["definition"] for r in L.read_dictionary(spark, str(p)).collect()}
    assert every == {"ok": "fine", "short": "two", "long": "x"}
    some = [r["word"] for r in L.read_dictionary(spark, str(p), skip_long_lines=True).collect()]
    assert sorted(some) == ["ok", "short"]


def test_dictionary_csv(spark, tmp_path):
    p = tmp_path / "dict.csv"
    p.write_text('word,definition,up_votes,author\nlol,"laugh, out\nloud",10,x\nyo,hey,3,y\nbad,row,notanumber,z\n')
    rows = {r["word"]: r for r in L.read_dictionary(spark, str(p)).collect()}
    assert rows["lol"]["definition"] == "laugh, out\nloud" and rows["lol"]["up_votes"] == 10
    assert rows["bad"]["up_votes"] is None and rows["yo"]["up_votes"] == 3
