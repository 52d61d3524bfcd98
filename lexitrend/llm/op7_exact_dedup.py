"""Exact dedup by content-defined chunk recipes, in DataFrame functions only.

A text is cut at places its own characters choose (a minimum length, then the next place where
the last three characters fall into fixed classes, at most a maximum length), so equal passages
are cut alike wherever they stand. Each chunk's identifier is its SHA-256. The identifiers are
verified: chunks with one identifier are compared character by character (an aggregate that
sends a distinct chunk once per task); if two differ under one identifier, all identifiers
get a second digest behind the first. A document becomes its *recipe*, the ordered list of identifiers (about
32 bytes for each ~1,500 characters), and documents are compared and grouped by recipe: long
texts are not moved again.

Results that are fixed here:

- a null text equals an empty text; the recipe of an empty text is an empty list;
- of equal texts the row with the largest ``doc_id`` stays; a null ``doc_id`` is smaller than all;
- rows repeated with the same ``doc_id`` and text are each returned, the same way;
- ``keep_rows`` (the pipeline's stage) keeps one row of each group, whatever its ``doc_id``: of rows with the
  largest id the one that comes last in the input; ``keep_one`` keeps all rows of the kept ids;
- an empty table gives an empty result; further columns are ignored by name (inner columns are
  renamed first, so names like ``recipe`` in the input do not clash).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import look_up, staged

MIN_CHARS = 1024
MAX_CHARS = 8192
#: A cut may fall behind three characters of these classes: about one place in 700 of prose.
CUT_CLASS = r"[aeiouhlrns][^\x{0}-\x{40}bcdefghi][ ,.\n][a-m]"


def chunks(text: Column, min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS) -> Column:
    """The chunks of a text in order, as ``array<string>``; together they are the text."""
    pattern = rf"(?s).{{{min_chars},{max_chars - 1}}}?(?:{CUT_CLASS})|.{{1,{max_chars}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _collisions(rows: DataFrame) -> DataFrame:
    """Identifiers that two or more different chunks share: ``(_id, _n)``, normally none.

    ``distinct`` keeps each different chunk once per task before the shuffle, however often it
    occurs; then different chunks are counted per identifier.
    """
    texts = rows.select(F.explode("_chunks").alias("_chunk")).select(
        F.unhex(F.sha2("_chunk", 256)).alias("_id"), "_chunk").distinct()
    several = texts.groupBy("_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return several


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *further: Column) -> DataFrame:
    """``(doc_id, recipe, text_sha256)`` and ``further`` for every row; the chunk identifiers are verified."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_doc"), chunks(text).alias("_chunks"),
                       F.sha2(text, 256).alias("_sha"), *further)
    clashing = staged(_collisions(rows), "collisions")
    recipe = F.transform("_chunks", lambda c: F.unhex(F.sha2(c, 256)))
    if not clashing.isEmpty():  # different texts under one identifier: use longer identifiers
        recipe = F.transform("_chunks", lambda c: F.unhex(F.concat(F.sha2(c, 256), F.sha2(F.reverse(c), 512))))
    return rows.select("_doc", recipe.alias("_recipe"), *rows.columns[2:])


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Two narrow shuffles by recipe: the group's largest id and size (summed per task first, so a
    group of any size sends one row per task), and the rows that look their group up, dealt over
    salts so that a very large group is not one task's work.
    """
    # Rows are dealt by a number of their own, as one id (or none) may stand in very many of them.
    r = staged(recipes(docs, id_col, text_col, F.monotonically_increasing_id().alias("_at")), "recipes")
    groups = r.groupBy("_recipe").agg(F.max("_doc").alias("keep_id"),
                                      F.count(F.lit(1)).alias("_size")).filter("_size > 1")
    found = look_up(r, groups.withColumnRenamed("_recipe", "_key"), {"_recipe": "_key"}, F.col("_at"))
    keep = F.when(F.col("_size").isNull(), F.col("_doc")).otherwise(F.col("keep_id"))
    return found.select(
        F.col("_doc").alias(id_col), keep.alias("keep_id"), F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("_doc").eqNullSafe(keep).alias("kept"),
        F.col("_sha").alias("text_sha256"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id stays, with all their columns."""
    kept = exact_groups(docs, id_col, text_col).filter("kept").select(
        F.col(id_col).alias("_keep")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(kept["_keep"]), "left_semi")


def keep_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Exactly one row of each group of equal texts, with all its columns."""
    number = "_number"
    while number.lower() in map(str.lower, docs.columns):
        number += "_"
    # Staged, so that a row has the same number each time it is read.
    rows = staged(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    r = staged(recipes(rows, id_col, text_col, F.col(number).alias("_at")).drop("_sha"), "recipes")
    groups = r.groupBy(F.col("_recipe").alias("_key")).agg(
        F.max(F.struct("_doc", "_at")).alias("_best"), F.count(F.lit(1)).alias("_size")).filter("_size > 1")
    found = look_up(r, groups, {"_recipe": "_key"}, F.col("_at"))
    kept = found.filter(F.col("_best").isNull() | (F.col("_at") == F.col("_best._at"))).select(F.col("_at").alias("_keep"))
    return rows.join(kept, rows[number] == kept["_keep"], "left_semi").drop(number)


ORACLE = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
