"""Sinks: monthly Parquet results, the fact table and the yearly tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import month_from_parts, zero_padded_month
from ..operators.fact import append_new_words
from ..session import ensure_checkpoint_dir
from . import swap


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a folder at ``path``; storage and permission errors are raised."""
    return swap.Folder(spark, path).exists(path)


def same_path(spark: SparkSession, a: str, b: str) -> bool:
    return swap.Folder(spark, a).qualified() == swap.Folder(spark, b).qualified()


#: Bytes of a file of a monthly table (``lexitrend.files.bytes``), and of its row groups.
FILE_BYTES_CONF = "lexitrend.files.bytes"
FILE_BYTES = 128 * 1024 * 1024
ROW_GROUP_BYTES = 8 * 1024 * 1024


def _clustered(rows: DataFrame, size: int, sort_by: Sequence[str]) -> DataFrame:
    """``rows`` (with ``year, month``) in ranges of ``(year, month, *sort_by)``, as many as their
    ``size`` in bytes asks for, sorted within. Ranges are sampled, so a month's number of files
    follows its bytes and not the number of tasks that made them, and no two files of a month
    overlap in ``sort_by``."""
    limit = int(rows.sparkSession.conf.get(FILE_BYTES_CONF, str(FILE_BYTES)))
    keys = ["year", "month", *sort_by]
    return rows.repartitionByRange(max(1, -(-size // limit)), *keys).sortWithinPartitions(*keys)


def write_monthly(df: DataFrame, out: str, month_col: str = "year_month", sort_by: Sequence[str] = ("word",),
                  months: Sequence[dt.date] | None = None, span: tuple[str | None, str | None] | None = None,
                  append: Sequence[dt.date] = (), token: str | None = None,
                  side: dict[str, DataFrame | str] | None = None) -> list[dt.date]:
    """Write a monthly result under ``year=/month=`` folders (snappy), replacing the months present
    in ``df``; returns them.

    Months that the write covers but ``df`` has no rows for are emptied: the listed ``months``, or
    every month of the table within ``span`` (first and last month, either may be None). Months in
    ``append`` are added to instead. A write whose ``token`` the table has seen does nothing.
    ``side`` frames (Parquet) and texts (small files) go beside the months under their names, which
    begin with ``_``, in the same swap.

    ``df`` is computed once, into a folder beside the table; that is measured, range-clustered on
    month and ``sort_by`` into files of about ``lexitrend.files.bytes``, and swapped in month by
    month (:mod:`lexitrend.sources.swap`), so a failed job leaves the table as it was. Beside a
    month's files lies ``_ranges``: the first and last value of ``sort_by[0]`` in each, by which
    :func:`read_words` opens only files that can hold a word."""
    spark = df.sparkSession
    table = swap.Folder(spark, out)
    place = swap.begin(table)
    if token is not None and swap.applied(table, token):
        return []
    m = F.col(month_col)
    (df.withColumn("year", F.year(m)).withColumn("month", zero_padded_month(F.month(m))).drop(month_col)
     .write.option("compression", "snappy").parquet(f"{place}/raw"))
    schema = T.StructType([*(f for f in df.schema.fields if f.name != month_col),
                           T.StructField("year", T.IntegerType()), T.StructField("month", T.StringType())])
    raw = spark.read.schema(schema).parquet(f"{place}/raw")
    (_clustered(raw, table.size(f"{place}/raw"), sort_by).write.option("compression", "snappy")
     .option("parquet.block.size", str(ROW_GROUP_BYTES)).partitionBy("year", "month").parquet(f"{place}/new"))
    written = table.months(f"{place}/new")
    if written:
        _write_ranges(spark, table, place, sort_by[0], written)
    for name, what in (side or {}).items():
        if isinstance(what, str):
            table.write(f"{place}/side/{name}", what)
        else:
            what.write.option("compression", "snappy").parquet(f"{place}/side/{name}")
    present = [x for x in written if x not in set(append)]
    covered = set(months or ())
    if span is not None:
        lo, hi = (dt.date.fromisoformat(str(x)) if x is not None else None for x in span)
        covered |= {x for x in table.months() if (lo is None or x >= lo) and (hi is None or x <= hi)}
    swap.commit(table, place, present, covered - set(written), [x for x in written if x in set(append)], token, side or ())
    return sorted(written)


def _write_ranges(spark: SparkSession, table: swap.Folder, place: str, column: str, written: dict[dt.date, str]) -> None:
    """One row per new file: its month and the first and last value of ``column``; a month's rows go
    into its folder, so they are swapped with it."""
    read = spark.read.option("basePath", f"{place}/new").parquet(f"{place}/new")
    (read.groupBy("year", "month", F.col("_metadata.file_name").alias("file"))
     .agg(F.min(column).alias("lo"), F.max(column).alias("hi"), F.count(F.lit(1)).alias("rows"))
     .withColumn("of_month", F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.lit(1)))
     .repartition("year", "month").write.partitionBy("year", "month").parquet(f"{place}/ranges"))
    for month, folder in table.months(f"{place}/ranges").items():
        table.rename(f"{place}/ranges/{folder}", f"{place}/new/{written[month]}/_ranges")


def word_files(spark: SparkSession, path: str, words: Sequence[str], start: str | None = None,
               end: str | None = None) -> list[str]:
    """The files of a monthly table that can hold one of ``words``: those whose range has one. At
    most about one file a month and word; the list is what the driver holds."""
    table = swap.Folder(spark, path)
    folders = [f"{table.path}/{f}/_ranges" for m, f in sorted(table.months().items())
               if (start is None or m >= dt.date.fromisoformat(str(start)))
               and (end is None or m <= dt.date.fromisoformat(str(end)))]
    if not folders or not words:
        return []
    wanted = F.array(*[F.lit(w) for w in words])
    schema = "file string, lo string, hi string, rows long, of_month date"
    ranges = spark.read.schema(schema).parquet(*folders)
    hit = F.exists(wanted, lambda w: (F.col("lo") <= w) & (w <= F.col("hi")))
    return sorted(f"{table.path}/{swap.month_folder(r['of_month'])}/{r['file']}" for r in ranges.filter(hit).collect())


def read_words(spark: SparkSession, path: str, words: Sequence[str], schema: T.StructType,
               start: str | None = None, end: str | None = None) -> DataFrame:
    """The rows of ``words`` in a table of :func:`write_monthly`: only files whose range can hold
    one of them are opened, and of those only the row groups (and pages) that can."""
    files = word_files(spark, path, words, start, end)
    if not files:
        return spark.createDataFrame([], schema)
    data = [f for f in schema.fields if f.name != "year_month"]
    reader = spark.read.option("basePath", path).schema(T.StructType(
        [*data, T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())]))
    found = reader.parquet(*files).filter(F.col("word").isin(list(words)))
    return found.withColumn("year_month", month_from_parts("year", "month")).select(*schema.names)


def read_monthly(spark: SparkSession, path: str, start: str | None = None, end: str | None = None,
                 schema: T.StructType | None = None) -> DataFrame:
    """Read a result written by :func:`write_monthly` back with its ``year_month`` column; the
    optional month bounds touch partition columns only, so Spark reads just those folders. With
    the ``schema`` of the result, a table whose months were all emptied reads as no rows."""
    reader = spark.read
    if schema is not None:
        data = [f for f in schema.fields if f.name != "year_month"]
        reader = reader.schema(T.StructType([*data, T.StructField("year", T.IntegerType()),
                                             T.StructField("month", T.IntegerType())]))
    df = reader.parquet(path)
    ym = month_from_parts("year", "month")
    if start is not None:
        df = df.filter(ym >= F.to_date(F.lit(str(start))))
    if end is not None:
        df = df.filter(ym <= F.to_date(F.lit(str(end))))
    return df.withColumn("year_month", ym).drop("year", "month")


def overwrite(df: DataFrame, out: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a whole table (used for ``word_definitions`` and the six yearly tables)."""
    writer = df.write.mode("overwrite").option("compression", "snappy").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(out)


def append_new(new: DataFrame, existing: DataFrame, key: Sequence[str], out: str) -> None:
    """Append only rows with a new key to the Parquet table at ``out``.

    The key set is cut from ``out``'s lineage with a checkpoint before the write, so the job
    never reads and writes the same files in one plan."""
    ensure_checkpoint_dir(new.sparkSession)
    rows = append_new_words(new, existing, key).checkpoint(eager=True)
    rows.write.mode("append").option("compression", "snappy").parquet(out)
