"""Comment sources: the monthly JSON archive and the partitioned Parquet layout.

Archive layout: ``<root>/<yyyy>/<name>_<yyyy>-<mm>.<ext>``, one JSON-lines file per month,
usually bz2 (splittable, so one file spreads over many tasks). Year comes from the folder, month
from the two digits before the extension. One job reads every month; there is no driver loop.

Parquet layout: ``<root>/year=<yyyy>/month=<mm>/...``. Month bounds become partition filters, so
only the wanted folders are listed and read.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import month_from_parts, zero_padded_month

YEAR_FROM_PATH = r"/(\d{4})/[^/]+$"
CORRUPT = "_corrupt"
MONTH_FROM_PATH = r"(\d{2})\.[^./]+$"


def month_of_path(path: str) -> tuple[str, str]:
    """Year and month of an archive file, as in :func:`read_archive`."""
    return tuple((re.search(p, path) or ("", ""))[1] for p in (YEAR_FROM_PATH, MONTH_FROM_PATH))


def _archive_lines(spark: SparkSession, root: str, glob: str, files: Sequence[str] | None = None) -> DataFrame:
    """Every line: all fields as text (so an odd value loses nothing else of its line), and
    ``_corrupt`` for lines that are no JSON object."""
    names = [f.name for f in schemas.RAW_COMMENT.fields] + ["id", CORRUPT]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return (spark.read.schema(schema).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).json(list(files) if files is not None else f"{root.rstrip('/')}/{glob}"))


def read_archive(spark: SparkSession, root: str, glob: str = "*/*", files: Sequence[str] | None = None) -> DataFrame:
    """Read the JSON archive (or the given files of it) and tag rows with ``year`` and ``month``.

    A line is dropped only if it is no JSON object at all (:func:`archive_report` counts those);
    a number field that is no whole number is NULL. ``doc_id`` is the comment's ``id``, or a
    per-row id that is stable across task retries.
    """
    # Spark parses a line only as far as it is asked to; the body is asked for along with the mark.
    lost = F.col(CORRUPT).isNotNull() & F.col("body").isNull()
    df = _archive_lines(spark, root, glob, files).filter(~lost)
    path = F.col("_metadata.file_path")
    text = {f.name for f in schemas.RAW_COMMENT.fields if isinstance(f.dataType, T.StringType)}
    df = df.withColumns({f.name: F.col(f.name).try_cast(f.dataType) for f in schemas.RAW_COMMENT.fields
                         if f.name not in text})
    return df.select(
        F.coalesce(F.col("id"), F.concat(F.lit("row-"), F.monotonically_increasing_id().cast("string")))
        .alias("doc_id"),
        "body", "subreddit", "score", "ups", "downs",
        F.regexp_extract(path, YEAR_FROM_PATH, 1).cast("int").alias("year"),
        F.regexp_extract(path, MONTH_FROM_PATH, 1).cast("int").alias("month"),
    )


def archive_report(spark: SparkSession, root: str, glob: str = "*/*") -> DataFrame:
    """``(file, lines, dropped, with_body)``: how many lines each archive file has, how many
    :func:`read_archive` drops (no JSON, and no body to be found in them), and how many have a body."""
    lost = F.col(CORRUPT).isNotNull() & F.col("body").isNull()
    return (_archive_lines(spark, root, glob).select(F.col("_metadata.file_path").alias("file"), CORRUPT, "body")
            .groupBy("file").agg(F.count(F.lit(1)).alias("lines"), F.count_if(lost).alias("dropped"),
                                 F.count("body").alias("with_body")))


def archive_months(spark: SparkSession, root: str, glob: str = "*/*") -> DataFrame:
    """Discover ``(year, month, file)`` of every archive file without reading row data."""
    df = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/{glob}").select("path")
    return df.select(
        F.regexp_extract("path", YEAR_FROM_PATH, 1).cast("int").alias("year"),
        F.regexp_extract("path", MONTH_FROM_PATH, 1).cast("int").alias("month"),
        F.col("path").alias("file"),
    )


def write_comment_parquet(comments: DataFrame, out: str) -> None:
    """Write comments to ``year=/month=`` folders (snappy). Months present in ``comments`` are
    replaced; other months in ``out`` stay (dynamic partition overwrite).

    ``body`` is kept: the sentiment job reads it from this output. There is no repartition by
    month: archive splits each hold one month already, and funnelling a month through one task
    would make the biggest month the slowest task.
    """
    (
        comments.select("doc_id", "body", "subreddit", "score", "ups", "downs",
                        F.col("year").cast("int").alias("year"),
                        zero_padded_month("month").alias("month"))
        .sortWithinPartitions("year", "month")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("year", "month")
        .parquet(out)
    )


def read_comment_parquet(spark: SparkSession, root: str, start: str | None = None,
                         end: str | None = None) -> DataFrame:
    """Comments from the Parquet layout, with ``year_month``; optional inclusive month bounds
    (``'YYYY-MM-01'``) are applied to partition columns only, so Spark prunes folders."""
    df = spark.read.parquet(root)
    ym = month_from_parts("year", "month")
    if start is not None:
        df = df.filter(ym >= F.to_date(F.lit(start)))
    if end is not None:
        df = df.filter(ym <= F.to_date(F.lit(end)))
    return df.withColumn("year_month", ym)


def month_range(comments: DataFrame, start: str | None = None, end: str | None = None,
                column: str = "year_month") -> DataFrame:
    """Keep rows whose month lies in ``[start, end]`` (inclusive; either bound optional)."""
    out = comments
    if start is not None:
        out = out.filter(F.col(column) >= F.to_date(F.lit(start)))
    if end is not None:
        out = out.filter(F.col(column) <= F.to_date(F.lit(end)))
    return out
