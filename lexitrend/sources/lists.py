"""Word lists and the dictionary CSV."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..constants import BAD_WORD_EXTRAS
from ..functions import strip_ws


SURPLUS = "_surplus"


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """One word per line -> ``DataFrame(word)``: stripped, lower-cased, blank lines dropped, set
    semantics."""
    df = spark.read.text(path)
    w = F.lower(strip_ws("value"))
    return df.select(w.alias("word")).filter(F.col("word") != "").distinct()


def normalize_word_list(words: DataFrame, column: str = "word") -> DataFrame:
    """Same cleaning as :func:`read_word_list` for a list that is already a DataFrame."""
    w = F.lower(strip_ws(column))
    return words.select(w.alias("word")).filter(F.col("word") != "").distinct()


def bad_words(words: DataFrame, extras: Iterable[str] = BAD_WORD_EXTRAS) -> DataFrame:
    """Bad-word list: cleaned list plus the fixed extra entries, as a set."""
    spark = words.sparkSession
    extra = spark.createDataFrame([(w,) for w in extras], schemas.WORD_LIST)
    return normalize_word_list(words).unionByName(extra).distinct()


def read_dictionary(spark: SparkSession, path: str, *, skip_long_lines: bool = False,
                    multi_line: bool = True) -> DataFrame:
    """Dictionary CSV with a header: ``word, definition, up_votes`` picked by name (other columns
    are ignored, in any order). Lines with too few fields are kept, their missing fields NULL;
    surplus fields are ignored, or with ``skip_long_lines`` lines that have some are left out (as
    the definitions are read; the word bank takes every line). A non-numeric ``up_votes`` becomes
    NULL (it then ranks last).

    Quoted fields may span lines (``multi_line``); Spark then reads each file in one task, which
    suits a dictionary. Without such fields, turn it off and the file is split."""
    options = {"header": True, "multiLine": multi_line, "escape": '"', "mode": "PERMISSIVE"}
    names = spark.read.options(**options).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, SURPLUS]])
    raw = spark.read.options(**options).schema(schema).csv(path)
    if skip_long_lines:
        raw = raw.filter(F.col(SURPLUS).isNull())
    return raw.select(
        F.col("word").cast("string").alias("word"),
        F.col("definition").cast("string").alias("definition"),
        F.col("up_votes").try_cast("long").alias("up_votes"),
    )
