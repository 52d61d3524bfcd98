"""Incremental month loading with Structured Streaming.

New comment files landing in the ``year=/month=`` Parquet layout are picked up by a file stream
(``trigger(availableNow=True)`` processes what is there and stops; a processing-time trigger
keeps watching).

A micro-batch is *added* to what is there: n-gram counts and the whole-number moments of sentiment
are sums, so the tables of its months are the state, and the batch's own counts and moments are added
to them. Frequencies, sentiment and facts of those months then follow from the tables. A late file
thus reads itself and the state of its months, never the month's other comments, and the result is
that of a full run. Which files a month holds is kept beside the tables: files that were added
before are left out, and when one of them is gone the month was rewritten, and it is recomputed
from all its files (:func:`refresh_months`). So are months under a sample ``target``, as the share that
is sampled depends on the whole month.

Every step is idempotent: a table takes a micro-batch once (its token is swapped in with the rows),
so one that is retried after an executor or driver loss goes on where it was cut off. The stream's
own progress lives in ``checkpoint_location`` (a shared folder on a cluster); a stream that was cut
off is resumed with the same one.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..functions import month_from_parts
from ..operators import fact as FT
from ..operators import frequency as FQ
from ..operators import sentiment as S
from ..sources import comments as SC
from ..sources import sinks as SK
from ..sources.swap import Folder, month_folder

MOMENTS = T.StructType([T.StructField("year_month", T.DateType()), T.StructField("word", T.StringType()),
                        *(T.StructField(c, T.LongType()) for c in ("n", "s1", "s2"))])


@dataclass
class MonthlyInputs:
    bank: DataFrame
    lexicon: DataFrame
    boosters: DataFrame | None = None
    negations: DataFrame | None = None
    stopwords: DataFrame | None = None
    target: int | None = None
    seed: int = 0
    ngram_orders: tuple[int, ...] = (1,)


def _moments(comments: DataFrame, inputs: MonthlyInputs) -> DataFrame:
    return S.monthly_word_moments(comments, inputs.bank, inputs.lexicon, inputs.boosters, inputs.negations,
                                  target=inputs.target, seed=inputs.seed)


def _of(spark: SparkSession, path: str, schema: T.StructType, months: list) -> DataFrame:
    """The rows of some months of a monthly table (none if there is no table yet)."""
    if not SK.table_exists(spark, path):
        return spark.createDataFrame([], schema)
    return SK.read_monthly(spark, path, schema=schema).filter(F.col("year_month").isin(months)).select(*schema.names)


def _publish(spark: SparkSession, root: str, months: list, inputs: MonthlyInputs) -> None:
    """Sentiment and facts of ``months`` from their counts and moments."""
    SK.write_monthly(S.from_moments(_of(spark, f"{root}/moments", MOMENTS, months)), f"{root}/sentiment", months=months)
    if 1 in inputs.ngram_orders:
        counts = _of(spark, f"{root}/1_gram_counts", schemas.NGRAM_COUNTS, months)
        sent = _of(spark, f"{root}/sentiment", schemas.WORD_SENTIMENT, months)
        SK.write_monthly(FT.words_fact(counts, sent, inputs.stopwords), f"{root}/words", months=months)


def refresh_months(spark: SparkSession, comments_root: str, out_root: str, months: list,
                   inputs: MonthlyInputs) -> None:
    """Recompute counts, sentiment and fact rows for ``months`` (a short list of month dates) from
    all their comments."""
    if not months:
        return
    root, source = out_root.rstrip("/"), Folder(spark, comments_root)
    held = {m: [n for n, *_ in source.files(f"{source.path}/{month_folder(m)}")] for m in months}
    comments = SC.read_comment_parquet(spark, comments_root).filter(F.col("year_month").isin(months))
    for n in inputs.ngram_orders:
        SK.write_monthly(FQ.monthly_ngrams(comments, n), f"{root}/{n}_gram_counts", months=months)
    SK.write_monthly(_moments(comments, inputs), f"{root}/moments", months=months)
    _publish(spark, root, months, inputs)
    for m, files in held.items():
        _note(spark, root, m, files)


def _known(spark: SparkSession, root: str, month: dt.date) -> list[str]:
    """The comment files of a month that its tables hold."""
    folder = Folder(spark, f"{root}/_files")
    path = f"{folder.path}/{month:%Y-%m}.json"
    return json.loads(folder.read(path)) if folder.exists(path) else []


def _note(spark: SparkSession, root: str, month: dt.date, files: list[str]) -> None:
    folder = Folder(spark, f"{root}/_files")
    folder.write(f"{folder.path}/{month:%Y-%m}.json", json.dumps(sorted(files)))


def add_files(spark: SparkSession, batch: DataFrame, comments_root: str, out_root: str, inputs: MonthlyInputs) -> None:
    """Add a batch of comments (``body, year_month, _file`` and the key) to the tables of its months."""
    root, source = out_root.rstrip("/"), Folder(spark, comments_root)
    # One row per file of the batch: bounded by the stream's batch size in files.
    arrived: dict[dt.date, list[str]] = {}
    for r in batch.select("year_month", "_file").distinct().collect():
        arrived.setdefault(r["year_month"], []).append(r["_file"])
    anew, new = [], {}
    for month, files in arrived.items():
        known = _known(spark, root, month)
        there = {n for n, *_ in source.files(f"{source.path}/{month_folder(month)}")}
        if inputs.target is not None or not set(known) <= there:
            anew.append(month)
        elif set(files) - set(known):
            new[month] = sorted(set(files) - set(known))
    refresh_months(spark, comments_root, out_root, sorted(anew), inputs)
    if not new:
        return
    months, files = sorted(new), sorted(f for x in new.values() for f in x)
    token = hashlib.sha256("\n".join(files).encode()).hexdigest()
    rows = batch.filter(F.col("year_month").isin(months) & F.col("_file").isin(files))
    for n in inputs.ngram_orders:
        path = f"{root}/{n}_gram_counts"
        state = _of(spark, path, schemas.NGRAM_COUNTS, months).select("year_month", "word", "count")
        counts = state.unionByName(FQ.word_counts(rows, n)).groupBy("year_month", "word").agg(
            F.sum("count").alias("count"))
        SK.write_monthly(FQ.with_frequency(counts), path, months=months, token=token)
    state = _of(spark, f"{root}/moments", MOMENTS, months)
    SK.write_monthly(S.merged(state.unionByName(_moments(rows, inputs)), "year_month", "word"), f"{root}/moments",
                     months=months, token=token)
    _publish(spark, root, months, inputs)
    for month, files in new.items():
        _note(spark, root, month, [*_known(spark, root, month), *files])


def start(spark: SparkSession, comments_root: str, out_root: str, checkpoint_location: str,
          inputs: MonthlyInputs, available_now: bool = True,
          processing_time: str | None = None) -> StreamingQuery:
    """Start the incremental loader over ``comments_root``; returns the running query."""
    schema = spark.read.parquet(comments_root).schema
    stream = spark.readStream.schema(schema).option("basePath", comments_root).parquet(comments_root)
    rows = stream.select("*", month_from_parts("year", "month").alias("year_month"),
                         F.col("_metadata.file_name").alias("_file"))

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        add_files(batch.sparkSession, batch, comments_root, out_root, inputs)

    writer = rows.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
