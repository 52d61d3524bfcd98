"""Monthly tables: clustered files, the month swap, single computation, and lookups by range."""

import datetime as dt
import os
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lexitrend.plans import jobs as J
from lexitrend.schemas import WORDS
from lexitrend.sources import sinks as SK
from lexitrend.sources import swap

JAN, FEB, MAR = (dt.date(2010, m, 1) for m in (1, 2, 3))


def facts(spark, months=(JAN, FEB, MAR), n=4000, count=1, parts=8):
    rows = spark.range(n).select(F.format_string("w%05d", F.col("id")).alias("word"))
    dates = F.explode(F.array(*[F.lit(m) for m in months])).alias("year_month")
    return rows.select("word", dates).select(
        "word", "year_month", F.lit(count).cast("long").alias("count"), F.rand(7).alias("frequency"),
        F.rand(8).alias("avg_sentiment"), F.rand(9).alias("stddev_sentiment")).repartition(parts)


def files(path):
    return sorted(p for p in Path(path).glob("year=*/month=*/*.parquet"))


def snapshot(spark, path):
    return {tuple(r) for r in SK.read_monthly(spark, path, schema=WORDS).select("word", "year_month", "count").collect()}


@pytest.mark.parametrize("parts", [1, 8, 40])
def test_files_follow_bytes_not_tasks(spark, tmp_path, parts):
    SK.write_monthly(facts(spark, parts=parts), str(tmp_path / "t"))
    assert 3 <= len(files(tmp_path / "t")) <= 3      # one file a month, however many tasks made the rows
    assert not list((tmp_path / "t").glob("_swap-*"))


def test_one_word_lookup_opens_one_file_a_month(spark, tmp_path):
    spark.conf.set(SK.FILE_BYTES_CONF, "60000")
    try:
        SK.write_monthly(facts(spark), str(tmp_path / "t"))
    finally:
        spark.conf.unset(SK.FILE_BYTES_CONF)
    every = files(tmp_path / "t")
    assert len(every) > 6
    opened = SK.word_files(spark, str(tmp_path / "t"), ["w02500"])
    assert len(opened) == 3                                                  # of three months
    got = SK.read_words(spark, str(tmp_path / "t"), ["w02500"], WORDS)
    assert len(got.inputFiles()) == 3
    want = SK.read_monthly(spark, str(tmp_path / "t")).filter("word = 'w02500'").select(*WORDS.names)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 3
    # row groups whose statistics can hold the word: one in each opened file
    hits = 0
    for f in opened:
        meta = pq.ParquetFile(f.removeprefix("file:")).metadata
        at = meta.schema.to_arrow_schema().get_field_index("word")
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            hits += s.min <= "w02500" <= s.max
    assert hits == 3
    assert SK.read_words(spark, str(tmp_path / "t"), ["w02500"], WORDS, start="2010-02-01", end="2010-02-01").count() == 1
    assert SK.read_words(spark, str(tmp_path / "t"), ["zzz"], WORDS).count() == 0
    assert SK.read_words(spark, str(tmp_path / "none"), ["w"], WORDS).count() == 0


def test_a_write_computes_its_rows_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def note(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = facts(spark, n=100)
    SK.write_monthly(df.mapInArrow(note, df.schema), str(tmp_path / "t"), months=[JAN, FEB, MAR])
    assert seen.value == 300


def test_emptied_months(spark, tmp_path):
    path = str(tmp_path / "t")
    SK.write_monthly(facts(spark, n=5), path)
    SK.write_monthly(facts(spark, (JAN,), n=5, count=2), path, months=[JAN, FEB])
    assert {(m, c) for _, m, c in snapshot(spark, path)} == {(JAN, 2), (MAR, 1)}
    SK.write_monthly(facts(spark, (JAN,), n=5, count=3), path, span=("2010-02-01", None))
    assert {(m, c) for _, m, c in snapshot(spark, path)} == {(JAN, 3)}
    SK.write_monthly(facts(spark, (JAN,), n=0), path, span=(None, None))
    assert snapshot(spark, path) == set()


def test_load_words_empties_a_month_without_sentiment(spark, tmp_path):
    counts, sent, words = (str(tmp_path / n) for n in ("counts", "sent", "words"))
    (tmp_path / "stop.txt").write_text("the\n")
    df = facts(spark, (JAN, FEB), n=5)
    SK.write_monthly(df.select("word", "year_month", "count", "frequency"), counts)
    SK.write_monthly(df.select("word", "year_month", "avg_sentiment", "stddev_sentiment"), sent)
    J.load_words(spark, counts, sent, str(tmp_path / "stop.txt"), words)
    assert {m for _, m, _ in snapshot(spark, words)} == {JAN, FEB}
    SK.write_monthly(df.select("word", "year_month", "avg_sentiment", "stddev_sentiment").filter(F.col("year_month") == JAN),
                     sent, span=(None, None))
    J.load_words(spark, counts, sent, str(tmp_path / "stop.txt"), words)
    assert {m for _, m, _ in snapshot(spark, words)} == {JAN}


class Cut(Exception):
    pass


def test_a_job_that_fails_before_the_swap_leaves_the_old_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    SK.write_monthly(facts(spark, (JAN, FEB), n=5), path)
    before = snapshot(spark, path)

    def cut(*_):
        raise Cut

    monkeypatch.setattr(swap, "commit", cut)
    with pytest.raises(Cut):
        SK.write_monthly(facts(spark, (JAN, MAR), n=5, count=2), path)
    assert snapshot(spark, path) == before
    monkeypatch.undo()
    swap.recover(swap.Folder(spark, path))                    # nothing was planned: only leftovers go
    assert snapshot(spark, path) == before and not list((tmp_path / "t").glob("_swap-*"))


@pytest.mark.parametrize("step", range(6))
def test_a_swap_that_is_cut_off_is_completed(spark, tmp_path, monkeypatch, step):
    """The renames of a replacing, adding and emptying write are cut off at every step."""
    path = str(tmp_path / "t")
    SK.write_monthly(facts(spark, (JAN, FEB, MAR), n=3), path)
    table, plain, done = swap.Folder(spark, path), swap.Folder.rename, []

    def rename(self, a, b):
        if "/new/" in a or "/old/" in b:
            if len(done) == step:
                raise Cut
            done.append(a)
        plain(self, a, b)

    monkeypatch.setattr(swap.Folder, "rename", rename)
    new = facts(spark, (JAN,), n=3, count=2).unionByName(facts(spark, (FEB,), n=1, count=9))
    try:
        SK.write_monthly(new, path, months=[MAR], append=[FEB], token="batch-1")
        cut = False
    except Cut:
        cut = True
    monkeypatch.undo()
    if cut:
        for month in table.months():                          # whole months only, old or new
            rows = [c for _, m, c in snapshot(spark, path) if m == month]
            assert sorted(rows) in ([1, 1, 1], [2, 2, 2], [1, 1, 1, 9])
        planned = any(Path(tmp_path / "t").glob("_swap-*/_plan.json"))
        swap.recover(table)
        if not planned:
            assert {(m, c) for _, m, c in snapshot(spark, path)} == {(JAN, 1), (FEB, 1), (MAR, 1)}
            return
    got = [(m, c) for _, m, c in snapshot(spark, path)]
    assert sorted(got) == [(JAN, 2)] * 3 + [(FEB, 1)] * 3 + [(FEB, 9)]
    assert swap.applied(table, "batch-1")
    assert SK.read_words(spark, path, ["w00000"], WORDS).count() == 3        # ranges follow the files
    assert SK.write_monthly(new, path, token="batch-1") == []               # once only
    assert len(snapshot(spark, path)) == 7
    assert os.listdir(tmp_path / "t") and not list((tmp_path / "t").glob("_swap-*"))
