"""Late files, zero-fill of changes only, and archive files that are read once."""

import bz2
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from lexitrend.operators import fact as FT
from lexitrend.plans import jobs as J
from lexitrend.schemas import WORDS
from lexitrend.sources import comments as SC
from lexitrend.sources import sinks as SK
from lexitrend.streaming import monthly as M

JAN, FEB = dt.date(2014, 1, 1), dt.date(2014, 2, 1)


def archive(root, month, rows, name="RC"):
    os.makedirs(f"{root}/2014", exist_ok=True)
    with bz2.open(f"{root}/2014/{name}_2014-{month:02d}.bz2", "wt") as f:
        f.writelines(json.dumps({"id": str(i), "body": b, "subreddit": "x", "score": 1}) + "\n" for i, b in rows)


def comments(spark, pq, month, rows):
    """One more file of a month."""
    df = spark.createDataFrame([(str(i), b, "x", 1, None, None, 2014, f"{month:02d}") for i, b in rows],
                               "doc_id string, body string, subreddit string, score long, ups long, downs long, year int, month string")
    df.coalesce(1).write.mode("append").partitionBy("year", "month").parquet(pq)


def tables(spark, out):
    names = ("1_gram_counts", "2_gram_counts", "moments", "sentiment", "words")
    return {n: sorted(map(str, SK.read_monthly(spark, f"{out}/{n}").collect())) for n in names}


def inputs(spark):
    return M.MonthlyInputs(bank=spark.createDataFrame([("yolo",), ("swag",)], "word string"), ngram_orders=(1, 2),
                           lexicon=spark.createDataFrame([("good", 2.0), ("bad", -2.0)], "word string, valence double"))


def test_late_files_are_added_and_equal_a_full_run(spark, tmp_path, monkeypatch):
    pq, out, ckpt = (str(tmp_path / x) for x in ("pq", "out", "ckpt"))
    given = inputs(spark)
    comments(spark, pq, 1, [(1, "yolo good"), (2, "yolo swag yolo bad"), (3, None)])
    comments(spark, pq, 2, [(4, "swag good good")])
    M.start(spark, pq, out, ckpt, given).awaitTermination()

    def whole_month(*_):
        raise AssertionError("a late file must not read its month again")

    monkeypatch.setattr(M.SC, "read_comment_parquet", whole_month)
    comments(spark, pq, 1, [(5, "yolo bad"), (6, "nothing else")])
    M.start(spark, pq, out, ckpt, given).awaitTermination()
    M.start(spark, pq, out, ckpt, given).awaitTermination()      # no new files: nothing changes
    # a retried batch is taken once
    batch = spark.read.parquet(pq).withColumn("year_month", F.make_date("year", "month", F.lit(1))).withColumn(
        "_file", F.col("_metadata.file_name"))
    M.add_files(spark, batch, pq, out, given)
    monkeypatch.undo()
    added = tables(spark, out)
    M.refresh_months(spark, pq, str(tmp_path / "full"), [JAN, FEB], given)
    assert added == tables(spark, str(tmp_path / "full"))
    assert any("yolo" in r for r in added["words"])


def test_a_batch_that_is_cut_off_goes_on(spark, tmp_path, monkeypatch):
    pq, out, ckpt = (str(tmp_path / x) for x in ("pq", "out", "ckpt"))
    given = inputs(spark)
    comments(spark, pq, 1, [(1, "yolo good")])
    M.start(spark, pq, out, ckpt, given).awaitTermination()
    comments(spark, pq, 1, [(2, "yolo bad swag")])
    plain = M._publish

    def cut(*_):
        raise RuntimeError("cut off")

    monkeypatch.setattr(M, "_publish", cut)
    with pytest.raises(Exception):
        M.start(spark, pq, out, ckpt, given).awaitTermination()
    monkeypatch.setattr(M, "_publish", plain)
    M.start(spark, pq, out, ckpt, given).awaitTermination()
    M.refresh_months(spark, pq, str(tmp_path / "full"), [JAN], given)
    assert tables(spark, out) == tables(spark, str(tmp_path / "full"))


def test_a_rewritten_month_is_recomputed(spark, tmp_path):
    raw, pq, out, ckpt = (str(tmp_path / x) for x in ("raw", "pq", "out", "ckpt"))
    given = inputs(spark)
    archive(raw, 1, [(1, "yolo good"), (2, "swag")])
    J.convert_archive(spark, raw, pq)
    M.start(spark, pq, out, ckpt, given).awaitTermination()
    archive(raw, 1, [(1, "yolo good good"), (2, "other")])
    J.convert_archive(spark, raw, pq)
    M.start(spark, pq, out, ckpt, given).awaitTermination()
    M.refresh_months(spark, pq, str(tmp_path / "full"), [JAN], given)
    assert tables(spark, out) == tables(spark, str(tmp_path / "full"))


def test_the_archive_is_read_once(spark, tmp_path):
    raw, pq = str(tmp_path / "raw"), str(tmp_path / "pq")
    archive(raw, 1, [(1, "a")])
    archive(raw, 2, [(2, "b")])
    assert len(J.convert_archive(spark, raw, pq)) == 2
    assert J.convert_archive(spark, raw, pq) == []
    archive(raw, 3, [(3, "c")])
    archive(raw, 2, [(4, "d d")], name="MORE")
    read = J.convert_archive(spark, raw, pq)
    assert sorted(os.path.basename(p) for p in read) == ["MORE_2014-02.bz2", "RC_2014-02.bz2", "RC_2014-03.bz2"]
    assert sorted(r["body"] for r in SC.read_comment_parquet(spark, pq).collect()) == ["a", "b", "c", "d d"]
    assert J.convert_archive(spark, raw, pq) == []


def fact(word, month, n=1):
    return (word, month, n, 0.5, 0.1, None)


def filled(spark, path):
    return {(r["word"], r["year_month"]): r["count"] for r in SK.read_monthly(spark, path, schema=WORDS).collect()}


def load(spark, path, rows, months):
    SK.write_monthly(spark.createDataFrame(rows, WORDS), path, months=months)


def test_zero_fill_writes_changes_only(spark, tmp_path):
    m = [dt.date(2010 + k // 12, k % 12 + 1, 1) for k in range(80)]          # more than one slot of bits
    words, out = str(tmp_path / "words"), str(tmp_path / "out")

    def check():
        full = FT.densify(SK.read_monthly(spark, words, schema=WORDS))
        want = {(r["word"], r["year_month"]): r["count"] for r in full.collect()}
        have = SK.read_monthly(spark, out, schema=WORDS)
        assert filled(spark, out) == want and have.count() == len(want)       # no row twice

    load(spark, words, [fact("a", m[0]), fact("b", m[2]), fact("a", m[70])], m)
    assert J.zero_fill(spark, words, out) == m[:71]
    check()
    assert J.zero_fill(spark, words, out) == []                              # nothing changed
    load(spark, words, [fact("b", m[71], 7)], [m[71]])
    stamp = {p: os.stat(p).st_mtime_ns for p in (str(x) for x in tmp_path.glob("out/year=*/month=*/*.parquet"))}
    assert J.zero_fill(spark, words, out) == [m[71]]                         # that month and no other
    assert all(os.stat(p).st_mtime_ns == t for p, t in stamp.items())
    check()
    load(spark, words, [fact("c", m[72]), fact("a", m[72])], [m[72]])        # a new word: its rows are added
    assert J.zero_fill(spark, words, out) == m[:73]
    assert all(os.stat(p).st_mtime_ns == t for p, t in stamp.items())
    check()
    load(spark, words, [fact("a", m[2])], [m[2]])                            # b leaves a month, a comes in
    assert J.zero_fill(spark, words, out) == [m[2]]
    check()
    load(spark, words, [fact("a", m[72])], [m[72]])                          # c has no row left at all
    J.zero_fill(spark, words, out)
    check()
    assert not any(w == "c" for w, _ in filled(spark, out))
    load(spark, words, [], [m[0]])                                           # the calendar begins later
    J.zero_fill(spark, words, out)
    check()
    load(spark, words, [], m)
    J.zero_fill(spark, words, out)
    assert filled(spark, out) == {}


def test_lookup_of_written_tables(spark, tmp_path):
    words, defs = str(tmp_path / "words"), str(tmp_path / "defs")
    load(spark, words, [fact("a", JAN), fact("b", JAN), fact("a", dt.date(2014, 3, 1), 4)], [])
    spark.createDataFrame([("a", "x"), ("zz", "y")], "word string, definition string").write.parquet(defs)
    got = [(r["word"], r["year_month"].month, r["count"]) for r in J.lookup(spark, words, defs, "A, b,zz").collect()]
    assert got == [("a", 1, 1), ("a", 2, 0), ("a", 3, 4)]
