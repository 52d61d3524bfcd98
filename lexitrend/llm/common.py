"""Shared helpers of the training-data operators: tables, staged results and Arrow slices."""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir

#: Characters of text that one step of a Python task handles at once (bounds its memory).
SLICE_CHARS = 1_500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables, by Spark's reader only."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """A fresh folder below the shared folder of ``spark.checkpoint.dir``; deleted with the JVM."""
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hpath)
    fs.deleteOnExit(hpath)
    return path


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the lineage, is
    computed once, and survives lost executors."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def look_up(rows: DataFrame, groups: DataFrame, keys: dict[str, str], spread: Column, salts: int = 16) -> DataFrame:
    """``rows`` left-joined with ``groups`` (one row per key; ``keys`` maps the rows' columns to the
    groups'). Each group is repeated per salt and ``spread`` deals a key's rows over the salts, so
    the rows of one very large group do not meet in one task. Give only groups of two rows or
    more: single rows then find nothing, and the repeated table stays small."""
    right = groups.withColumn("_salt_g", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    left = rows.withColumn("_salt_r", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    on = F.col("_salt_r") == F.col("_salt_g")
    for a, b in keys.items():
        on = on & (F.col(a) == F.col(b))
    return left.join(right, on, "left").drop("_salt_r", "_salt_g", *keys.values())


#: A key with more than this part of all rows (and ``SLICE_ROWS`` at least) is split into slices.
HOT_PARTS, SLICE_ROWS = 1000, 200


def hot_keys(counts: DataFrame, keys: list[str], n: str, total: int) -> DataFrame:
    """Keys of ``counts`` (one row per key, ``n`` rows each) that hold more than a ``HOT_PARTS``-th of
    at most ``total`` rows, as ``_hot0, ..``, and the number ``_slices`` of parts of at most that size
    they go into. Fewer than ``HOT_PARTS`` keys can hold so many, which bounds their broadcast, and
    all slices together are fewer than twice that."""
    limit = max(total // HOT_PARTS, SLICE_ROWS)
    return counts.filter(F.col(n) > limit).select(
        *[F.col(k).alias(f"_hot{i}") for i, k in enumerate(keys)], F.ceil(F.col(n) / limit).cast("int").alias("_slices"))


def split_join(rows: DataFrame, groups: DataFrame, keys: list[str], hot: DataFrame, spread: Column,
               how: str = "inner") -> DataFrame:
    """``rows`` joined with ``groups`` (one row per key) on ``keys``. Rows of a key in ``hot`` (see
    ``hot_keys``) are dealt by ``spread`` over its slices, and its group is repeated once per slice, so
    no task meets more than a slice of a key; all other rows and groups are shuffled once."""
    def marked(side: DataFrame) -> DataFrame:
        on = functools.reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_hot{i}") for i, k in enumerate(keys)])
        return side.join(F.broadcast(hot), on, "left").drop(*[f"_hot{i}" for i in range(len(keys))])

    slices_of = F.coalesce(F.col("_slices"), F.lit(1))
    left = marked(rows).withColumn("_slice", F.pmod(F.xxhash64(spread), slices_of).cast("int")).drop("_slices")
    right = marked(groups).withColumn("_slice", F.explode(F.sequence(F.lit(0), slices_of - 1))).drop("_slices")
    return left.join(right, [*keys, "_slice"], how).drop("_slice")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application (``addPyFile``)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="lexitrend-py-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with this package on the workers; a task that is done gives its freed memory
    back to the system, as its worker lives on beside the next stage's tasks."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        trim()

    return df.mapInArrow(run, schema)


def trim() -> None:
    """Give freed memory back to the system (where the C library can)."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back is not None:
        give_back(0)


def slices(column: pa.Array, limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges ``(lo, hi)`` of rows with about ``limit`` bytes of text each (one row at least)."""
    n = len(column)
    if n == 0:
        return
    sizes = np.array(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
    lo, total = 0, 0
    for i in range(n):
        if i > lo and total + sizes[i] > limit:
            yield lo, i
            lo, total = i, 0
        total += int(sizes[i])
    yield lo, n


def texts_of(column: pa.Array, lo: int, hi: int) -> list[str]:
    """Rows ``lo`` to ``hi`` as strings; null counts as empty."""
    return [t or "" for t in column.slice(lo, hi - lo).to_pylist()]


def out_batch(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for f, c in
         ((f, columns[f.name]) for f in schema)], schema=schema)


# --- hashes of words, in numpy ------------------------------------------------------------

_MULT = np.uint64(0x9E3779B97F4A7C15)
_R = 0xD6E8FEB86659FD93          # odd, so it has an inverse modulo 2**64
_R_INV = pow(_R, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def word_chars() -> np.ndarray:
    """For each code point, whether it belongs to words (letters and digits)."""
    return np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


@functools.lru_cache(maxsize=2)
def _powers(n: int, base: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = base
    return np.multiply.accumulate(out)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs of letters and digits, lower case) of all texts in order, and
    the index of the text each word is from. No Python loop over words."""
    joined = "\n".join(t.lower() for t in texts)
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(cp):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    inside = word_chars()[cp]
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    size = 1 << max(16, int(len(cp)).bit_length())
    value = mix64(cp.astype(np.uint64) + _MULT) * _powers(size, _R)[: len(cp)]
    value *= inside
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)))
    hashes = mix64((prefix[end] - prefix[start]) * _powers(size, _R_INV)[start])
    ends = np.cumsum(np.fromiter((len(t.lower()) + 1 for t in texts), np.int64, len(texts)))
    return hashes, np.searchsorted(ends, start, side="right")
