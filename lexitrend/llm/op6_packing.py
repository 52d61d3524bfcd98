"""Packing documents into sequences by cutting-stock column generation.

Documents are tokenised once, cut into full sequences and a rest, and the rests' lengths are
counted in classes of ``CLASS`` ids (rounded up). A linear programme over patterns (how many
pieces of each class fill one sequence) covers the counts with the fewest sequences; an
unbounded knapsack by dynamic programming prices new patterns until the best one could lower the
total by at most 0.05 %. The
rounded-down programme leaves a bounded residue (fewer pieces than patterns hold), which best
fit packs. The plan is small: its size depends on the number of classes, never on the data.
Every piece then finds its place from its rank within its class: ranks are counted within salted
parts of a class, as many as its share of all pieces, so a length that a third of all documents
have is a third of the parts and not one task's work.

Results that are fixed here:

- a null text is an empty text: the end id alone, a document of one id;
- each id lies in exactly one piece; pieces of one document are cut at multiples of the sequence
  length, so they do not depend on other documents;
- rows with equal or null ids are all packed; ranks between equals follow length, start, checksum;
- a sequence shorter than ``seq_len`` is padded, unless its length is a power of two;
- an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, out_batch, slices, staged

SEQ_LEN = 4096
CLASS = 8
#: All classes together are ranked in about so many parts, each class in as many as its share.
PARTS = 4096


# --- the cutting-stock problem, in numpy; its size is the number of classes -------------------

def price(duals: np.ndarray, capacity: int) -> np.ndarray:
    """The most valuable pattern: how many pieces of each size (index + 1) fill ``capacity``."""
    best, take = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        gain = duals[:c] + best[c - 1::-1][:c]      # size s = 1..c, then the best of c - s
        s = int(gain.argmax())
        if gain[s] > best[c - 1]:
            best[c], take[c] = gain[s], s + 1
        else:
            best[c] = best[c - 1]
    pattern, c = np.zeros(capacity, np.int64), capacity
    while c > 0:
        if take[c]:
            pattern[take[c] - 1] += 1
            c -= take[c]
        else:
            c -= 1
    return pattern


def _inverse(a: np.ndarray) -> np.ndarray:
    """Gauss-Jordan with row exchanges: plain array operations, so no linear-algebra threads
    contend with Spark's on the driver's machine."""
    n = len(a)
    work = np.concatenate((a, np.eye(n)), axis=1)
    for k in range(n):
        p = k + int(np.abs(work[k:, k]).argmax())
        if p != k:
            work[[k, p]] = work[[p, k]]
        work[k] /= work[k, k]
        rows = np.flatnonzero(work[:, k])
        rows = rows[rows != k]
        if len(rows):
            work[rows] -= work[rows, k][:, None] * work[k]
    return work[:, n:]


def column_generation(demand: np.ndarray, gap: float = 5e-4,
                      max_rounds: int = 6000) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often each is used (fractional), covering ``demand`` (pieces per size;
    index 0 is size 1, the last index is the capacity) with the fewest sequences.

    A revised simplex method: the basis starts with greedy patterns, each of which uses up one
    size (so they are independent); the pricing knapsack brings in columns until the bound it gives (total / value of the best pattern) is within
    ``gap`` of the total, or the total is within ``gap`` of the lengths' sum. Pricing with duals
    drawn towards each size's share of a sequence (dual smoothing) keeps the rounds few.
    """
    capacity = len(demand)
    sizes = np.flatnonzero(demand) + 1
    m = len(sizes)
    if not m:
        return []
    basis, x, left = np.zeros((m, m)), np.zeros(m), demand[sizes - 1].astype(float)
    open_sizes = np.ones(m, bool)
    for _ in range(m):                               # each greedy pattern uses up one size
        column, room = np.zeros(m), capacity
        for k in np.flatnonzero(open_sizes)[::-1]:
            if sizes[k] <= room:
                column[k] = room // sizes[k]
                room -= int(column[k]) * int(sizes[k])
        ratio = np.divide(left, column, out=np.full(m, np.inf), where=column > 0)
        out = int(ratio.argmin())
        basis[:, out], x[out] = column, ratio[out]
        left = np.maximum(left - ratio[out] * column, 0)
        left[out], open_sizes[out] = 0, False
    inverse = _inverse(basis)
    share = sizes / capacity                         # the duals if every sequence were full
    step = 0
    while step < max_rounds and x.sum() > (1 + gap) * (share @ demand[sizes - 1]):
        step += 1
        duals = inverse.sum(0)                       # all costs are 1
        for weight in (0.8, 0.4, 0.0):               # priced near the full-sequence duals first
            value = np.full(capacity, -1.0)
            value[sizes - 1] = np.maximum(weight * share + (1 - weight) * duals, 0)
            column = price(value, capacity)[sizes - 1].astype(float)
            if column @ duals > 1 + (gap if weight == 0 else 0.01):
                break
        else:
            break
        direction = np.einsum("ij,j->i", inverse, column)
        up = direction > 1e-9
        if not up.any():
            break
        ratio = np.full(m, np.inf)
        ratio[up] = x[up] / direction[up]
        out = int(np.argmin(ratio))
        theta = ratio[out]
        x = x - theta * direction
        x[out] = theta
        basis[:, out] = column
        inverse[out] /= direction[out]
        rest = direction.copy()
        rest[out] = 0
        inverse -= np.outer(rest, inverse[out])
        if step % 1000 == 0:                         # afresh, against rounding errors
            inverse = _inverse(basis)
            x = np.maximum(inverse @ demand[sizes - 1], 0)
    out_patterns = []
    for k in range(m):
        pattern = np.zeros(capacity, np.int64)
        pattern[sizes - 1] = np.rint(basis[:, k]).astype(np.int64)
        out_patterns.append((pattern, float(max(0.0, x[k]))))
    return out_patterns


def cutting_plan(demand: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Whole patterns and their counts that hold exactly ``demand``: the rounded-down programme,
    and best fit in descending order for the residue."""
    left = demand.astype(np.int64).copy()
    plan: list[tuple[np.ndarray, int]] = []
    for pattern, x in sorted(column_generation(demand), key=lambda p: -p[1]):
        used = pattern > 0
        times = int(min(np.floor(x + 1e-6), (left[used] // pattern[used]).min())) if used.any() else 0
        if times > 0:
            plan.append((pattern, times))
            left -= times * pattern
    capacity = len(demand)
    rooms: list[list] = []                           # [room, pattern]
    by_room: dict[int, list[int]] = {}
    for size in range(capacity, 0, -1):
        for _ in range(int(left[size - 1])):
            room = next((r for r in range(size, capacity + 1) if by_room.get(r)), None)
            if room is None:
                k = len(rooms)
                rooms.append([capacity, np.zeros(capacity, np.int64)])
            else:
                k = by_room[room].pop()
            rooms[k][0] -= size
            rooms[k][1][size - 1] += 1
            by_room.setdefault(rooms[k][0], []).append(k)
    same: dict[bytes, list] = {}
    for _, pattern in rooms:
        same.setdefault(pattern.tobytes(), [pattern, 0])[1] += 1
    return plan + [(p, n) for p, n in same.values()]


# --- Spark jobs --------------------------------------------------------------------------------

def pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 2, seq_len: int = SEQ_LEN,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens``: every document's full pieces and rest."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .tokens import SLICE_CHARS, encoder_of

        encoder = encoder_of(tokenizer_path)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            schema = pa.schema([("doc_id", ids.type), ("start", pa.int64()), ("length", pa.int64()),
                                ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])
            for lo, hi in slices(texts, SLICE_CHARS):
                tokens, size = encoder.encode_ended(texts.slice(lo, hi - lo), end_id)
                raw, first = memoryview(tokens.tobytes()), (np.cumsum(size) - size).tolist()
                at, start, length, crc, total = [], [], [], [], []
                for k, (a, n) in enumerate(zip(first, size.tolist())):
                    for begin in range(0, n, seq_len):
                        part = raw[4 * (a + begin): 4 * (a + min(n, begin + seq_len))]
                        at.append(lo + k)
                        start.append(begin)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        total.append(n)
                yield out_batch(schema, {"doc_id": ids.take(pa.array(at, pa.int64())), "start": start,
                                         "length": length, "ids_crc32": crc, "doc_tokens": total})

    return map_arrow(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, start long, length long, "
                                "ids_crc32 long, doc_tokens long")


def plan_rows(demand: np.ndarray, first_sequence: int) -> list[tuple[int, int, int, int, int]]:
    """``(class, first rank, last rank + 1, pieces per sequence, first sequence)`` per pattern."""
    used = np.zeros(len(demand), np.int64)
    rows, sequence = [], first_sequence
    for pattern, times in cutting_plan(demand):
        for k in np.flatnonzero(pattern):
            each = int(pattern[k])
            rows.append((int(k) + 1, int(used[k]), int(used[k]) + times * each, each, sequence))
            used[k] += times * each
        sequence += times
    return rows


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, seq_len: int = SEQ_LEN,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    spark = docs.sparkSession
    cut = staged(pieces(docs, tokenizer_path, end_id, seq_len, id_col, text_col), "pieces").withColumn(
        "_class", F.ceil(F.col("length") / CLASS).cast("int"))
    # At most seq_len / CLASS rows, then at most PARTS more, whatever the input.
    sizes = {r["_class"]: r["count"] for r in cut.groupBy("_class").count().collect()}
    total = sum(sizes.values())
    parts = spark.createDataFrame([(c, -(-n * PARTS // total)) for c, n in sizes.items()], "_class int, _parts int")
    cut = cut.join(F.broadcast(parts), "_class").withColumn("_salt", F.pmod(
        F.xxhash64("doc_id", "start", "ids_crc32"), F.col("_parts")).cast("int")).drop("_parts")
    counts = cut.groupBy("_class", "_salt").count().collect()
    classes = seq_len // CLASS
    demand = np.zeros(classes, np.int64)
    offsets = []
    for row in sorted(counts, key=lambda r: (r["_class"], r["_salt"])):
        offsets.append((row["_class"], row["_salt"], int(demand[row["_class"] - 1])))
        demand[row["_class"] - 1] += row["count"]
    full = int(demand[-1])                            # full pieces are a sequence each
    demand[-1] = 0
    plan = [(classes, 0, full, 1, 0), *plan_rows(demand, full)]
    offset_rows = spark.createDataFrame(offsets, "_class int, _salt int, _before long")
    plan_df = spark.createDataFrame(plan, "_class int, _from long, _to long, _each long, _first long")
    ranked = cut.withColumn("_rank", F.row_number().over(
        Window.partitionBy("_class", "_salt").orderBy("doc_id", "length", "start", "ids_crc32"))).join(
        F.broadcast(offset_rows), ["_class", "_salt"]).withColumn(
        "_rank", F.col("_before") + F.col("_rank") - 1)
    placed = ranked.join(F.broadcast(plan_df), "_class").filter(
        (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))).withColumn(
        "sequence_id", F.col("_first") + F.expr("(_rank - _from) div _each"))
    inside = Window.partitionBy("sequence_id").orderBy("doc_id", "start", "_rank", "_class").rowsBetween(
        Window.unboundedPreceding, -1)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset"))
