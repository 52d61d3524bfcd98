"""Joins with dimensions (word bank, lexicon, stopwords): broadcast only what has been measured.

A dimension is materialized once with ``checkpoint()`` into the session's checkpoint directory
and its bytes are summed. At most ``lexitrend.broadcast.maxBytes`` of it is broadcast; a larger
one is joined by a shuffle on the key and a salt: each row of the large side takes one of
``SALTS`` salts by its own hash and the dimension is repeated once per salt, so neither a hot
word nor the rows with a NULL key become one task's work; where misses are not asked for, a broadcast
Bloom filter of the dimension's keys first drops sure misses. Both ways give the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

MAX_BYTES_CONF = "lexitrend.broadcast.maxBytes"
BLOOM_BYTES_CONF = "lexitrend.bloom.maxBytes"
DEFAULT_MAX_BYTES = 100 * 1024 * 1024
SALTS = 16
_ROW_BYTES = 16


@dataclass(frozen=True)
class Dimension:
    """A materialized dimension and its size."""

    df: DataFrame
    size: int


def dimension(df: DataFrame | Dimension) -> Dimension:
    """Materialize and measure ``df`` (once: a :class:`Dimension` is returned as it is)."""
    if isinstance(df, Dimension):
        return df
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)
    width = F.lit(_ROW_BYTES + 8 * len(df.columns))
    for name, kind in df.dtypes:
        if kind == "string":
            width = width + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
    size = df.agg(F.sum(width.cast("long"))).first()[0] or 0
    return Dimension(df, int(size))


#: A Bloom filter of a dimension: rows of so many bits, bits per key in all, and bits set per key.
BLOOM_ROW_BITS, BLOOM_KEY_BITS, BLOOM_HASHES = 4096, 12, 5


def _bloom_places(key: Column, rows: int) -> tuple[Column, list[Column]]:
    """The filter row of a key, and the bits that stand for it there."""
    bits = F.xxhash64(key, F.lit("bits"))
    return F.pmod(F.xxhash64(key), F.lit(rows)).cast("int"), [
        F.shiftrightunsigned(bits, 12 * k).bitwiseAND(F.lit(BLOOM_ROW_BITS - 1)).cast("int") for k in range(BLOOM_HASHES)]


def bloom_filter(keys: DataFrame, on: str, count: int) -> tuple[DataFrame, int]:
    """A blocked Bloom filter of the keys as a table ``(_row, _bits)`` with 64 whole numbers a row,
    and the number of its rows (``BLOOM_KEY_BITS`` bits for each of ``count`` keys)."""
    rows = max(1, -(-count * BLOOM_KEY_BITS // BLOOM_ROW_BITS))
    row, places = _bloom_places(F.col(on), rows)
    set_bits = keys.filter(F.col(on).isNotNull()).select(row.alias("_row"), F.explode(F.array(*places)).alias("_bit"))
    word = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("_bit", F.lit(64)).cast("int"))
    words = set_bits.groupBy("_row", F.floor(F.col("_bit") / 64).cast("int").alias("_at")).agg(F.bit_or(word).alias("_w"))
    table = words.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("_at", "_w"))).alias("_m"))
    return table.select("_row", F.transform(F.sequence(F.lit(0), F.lit(BLOOM_ROW_BITS // 64 - 1)), lambda i: F.coalesce(
        F.try_element_at("_m", i), F.lit(0).cast("long"))).alias("_bits")), rows


def without_sure_misses(left: DataFrame, dim: Dimension, on: str, limit: int, keep: Column | None = None) -> DataFrame:
    """``left`` without rows whose key the dimension certainly lacks (rows that ``keep`` names stay),
    by broadcasting a Bloom filter of its keys, where that has at most ``limit`` bytes. The rest, about
    the hits and one in some hundred of the others, is what a join still has to move."""
    count = dim.df.count()
    if count * BLOOM_KEY_BITS // 8 > limit:
        return left
    table, rows = bloom_filter(dim.df, on, count)
    row, places = _bloom_places(F.col(on), rows)
    hit = F.lit(True)
    for p in places:
        hit = hit & (F.call_function("getbit", F.get("_bits", F.floor(p / 64).cast("int")), F.pmod(p, F.lit(64))) == 1)
    hit = F.col("_bits").isNotNull() & hit
    tested = left.withColumn("_row_of", row).join(F.broadcast(table), F.col("_row_of") == F.col("_row"), "left")
    return tested.filter(hit if keep is None else F.coalesce(keep, F.lit(False)) | hit).select(*left.columns)


def is_broadcast(left: DataFrame, dim: Dimension) -> bool:
    """Whether :func:`join_dimension` broadcasts this dimension."""
    return dim.size <= int(left.sparkSession.conf.get(MAX_BYTES_CONF, str(DEFAULT_MAX_BYTES)))


def join_dimension(left: DataFrame, dim: DataFrame | Dimension, on: str, how: str,
                   wanted: Column | None = None) -> DataFrame:
    """``left`` joined with a dimension on one column (``how``: left, left_semi, left_anti or
    inner): by broadcast when it is small enough, else by a salted shuffle join, before which a Bloom
    filter (within ``lexitrend.bloom.maxBytes``, 100 MB) drops rows that cannot match. A left join
    keeps all rows; with ``wanted`` it may leave out rows that neither match nor are wanted."""
    dim = dimension(dim)
    columns = left.columns + ([] if how in ("left_semi", "left_anti") else [c for c in dim.df.columns if c != on])
    if is_broadcast(left, dim):
        return left.join(F.broadcast(dim.df), on, how).select(*columns)
    if how in ("inner", "left_semi") or (how == "left" and wanted is not None):
        bloom = int(left.sparkSession.conf.get(BLOOM_BYTES_CONF, str(DEFAULT_MAX_BYTES)))
        left = without_sure_misses(left, dim, on, bloom, wanted if how == "left" else None)
    salted = dim.df.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # A NULL key matches nothing; it gets a key of its own so that such rows spread as well.
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(SALTS)).cast("int")
    spread = left.withColumns({"_salt": salt, "_key": F.coalesce(
        F.concat(F.lit("="), F.col(on)), F.xxhash64(*[F.col(c) for c in left.columns]).cast("string"))})
    right = salted.withColumn("_key", F.concat(F.lit("="), F.col(on))).drop(on)
    return spread.join(right, ["_key", "_salt"], how).select(*columns)


def broadcast_bounded(df: DataFrame) -> DataFrame:
    """``broadcast(df)`` for a frame whose size is bounded by construction, not by data volume
    (one row per calendar month, per year, or a fixed list). Callers say why at the call site."""
    return F.broadcast(df)
