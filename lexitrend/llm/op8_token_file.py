"""Token files: canonical length-limited Huffman codes, independent blocks, bit checkpoints.

Texts are encoded to ids, the end id is appended, and the ids are counted over all documents
(summed per task, then per id: at most one row per vocabulary entry reaches the driver, where
package-merge gives code lengths of at most ``MAX_BITS``). The ids are range-partitioned by
``doc_id`` and each task writes blocks of whole documents. A file set is a folder with

- ``codebook``: ``(id, bits)``; the canonical codes follow from these lengths alone;
- ``blocks``: per block its place (``part``, ``block``), the ids of all documents of the part
  before it, its documents' ids and lengths, the bit string ``payload`` (most significant bit
  first) and ``checkpoints``, the bit offset of every ``CHECKPOINT``-th code.

A block is decoded without any other: all stretches between checkpoints advance together, one
table look-up per code.

Results that are fixed here:

- a null text is an empty text: the end id alone; texts of any length stay in one block;
- documents are in ascending ``doc_id`` order, null ids first; rows with equal ids are ordered by
  length and checksum, and each keeps its own place;
- an empty table gives an empty file set and an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_arrow, out_batch, slices, staged, work_dir

MAX_BITS = 20
BLOCK_IDS = 1 << 19
CHECKPOINT = 512
#: Ids that are coded at once; a multiple of ``CHECKPOINT``.
RUN = 1 << 15
#: Codebooks up to this many ids are sent to the tasks (a vocabulary, never data).
MAX_VOCABULARY = 2_000_000


# --- code construction and coding of one block, in numpy ------------------------------------

def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal prefix-code lengths of at most ``limit`` bits (package-merge); 0 where unused."""
    lengths = np.zeros(len(counts), np.int64)
    used = np.flatnonzero(counts > 0)
    n = len(used)
    if n <= 1:
        lengths[used] = 1
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} symbols need more than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    level, leaf_flags = leaves, [np.ones(n, bool)]
    for _ in range(limit - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate((leaves, pairs))
        rank = np.argsort(both, kind="stable")
        level = both[rank]
        leaf_flags.append(rank < n)
    take = 2 * n - 2
    for flags in reversed(leaf_flags):
        here = flags[:take]
        k = int(here.sum())
        lengths[order[:k]] += 1
        take = 2 * (len(here) - k)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id)."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        bits = lengths[order]
        top = int(bits.max())
        steps = np.concatenate(([0], np.cumsum(1 << (top - bits))[:-1]))
        codes[order] = (steps >> (top - bits)).astype(np.uint64)
    return codes


def encode_block(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bit string of ``ids`` and the bit offset of every ``CHECKPOINT``-th code. Ids are put
    into 64-bit words a short run at a time, so that the run's arrays stay in the cache."""
    bits = lengths.astype(np.uint8)
    if len(ids) % 2:
        ids = np.append(ids, ids[:1])       # takes no bits, see below
        odd = True
    else:
        odd = False
    # Two codes at a time, which fit a word (code lengths are at most 32).
    words = np.zeros(int(bits[ids].sum(dtype=np.int64) >> 6) + 2, np.uint64)
    marks, base = [], 0
    for lo in range(0, len(ids), RUN):
        part = ids[lo: lo + RUN]
        each, code = bits[part], codes[part]
        if odd and lo + RUN >= len(ids):
            each[-1], code[-1] = 0, 0
        code = code[::2] << each[1::2] | code[1::2]
        size = (each[::2] + each[1::2]).astype(np.int64)
        end = np.cumsum(size) + base
        at = end - size
        marks.append(at[::CHECKPOINT // 2])
        word, room = at >> 6, 64 - (at & 63) - size
        value = code << np.maximum(room, 0).astype(np.uint64)
        over = np.flatnonzero(room < 0)                    # codes that go on in the next word
        value[over] = code[over] >> (-room[over]).astype(np.uint64)
        first = np.append(0, np.flatnonzero(word[1:] != word[:-1]) + 1)
        words[word[first]] |= np.bitwise_or.reduceat(value, first)
        words[word[over] + 1] |= code[over] << (64 + room[over]).astype(np.uint64)
        base = int(end[-1])
    return words.astype(">u8").tobytes()[: (base + 7) // 8], np.concatenate(marks)


def decode_table(lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, int]:
    """``id * 32 + bits`` for each possible run of ``top`` bits."""
    top = int(lengths.max(initial=1))
    table = np.zeros(1 << top, np.uint32)
    order = np.lexsort((codes, lengths))
    order = order[lengths[order] > 0]
    spans = 1 << (top - lengths[order])
    table[: int(spans.sum())] = np.repeat((order << 5 | lengths[order]).astype(np.uint32), spans)
    return table, top


def decode_block(payload: bytes, checkpoints: np.ndarray, n: int, table: np.ndarray, top: int) -> np.ndarray:
    """The ``n`` ids of a block; every stretch between checkpoints is a lane."""
    b = np.frombuffer(payload + b"\0" * 8, np.uint8).astype(np.uint32)
    window = (b[:-3] << np.uint32(24) | b[1:-2] << np.uint32(16) | b[2:-1] << np.uint32(8) | b[3:]).astype(np.int64)
    lanes = len(checkpoints)
    out = np.zeros((CHECKPOINT, lanes), np.uint32)
    # Places are 64-bit throughout: numpy would copy indices of any other kind.
    at, shift, mask = checkpoints.copy(), 32 - top, (1 << top) - 1
    tail = n - (lanes - 1) * CHECKPOINT
    for step in range(CHECKPOINT if lanes > 1 else tail):
        if step == tail:
            at = at[:-1]
        entry = table.take(window.take(at >> 3) >> (shift - (at & 7)) & mask)
        out[step, : len(at)] = entry
        at = at + (entry & 31)
    out >>= np.uint32(5)
    return out.T.reshape(-1)[:n]


# --- Spark jobs ------------------------------------------------------------------------------

def token_rows(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``(_doc, _n, _crc, _ids)``: each document's ids with the end id, little-endian 32-bit."""
    rows = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .tokens import SLICE_CHARS, encoder_of

        encoder = encoder_of(tokenizer_path)
        for batch in batches:
            docs_, texts = batch.column(0), batch.column(1)
            schema = pa.schema([("_doc", docs_.type), ("_n", pa.int64()), ("_crc", pa.int64()),
                                ("_ids", pa.binary())])
            for lo, hi in slices(texts, SLICE_CHARS):
                ids, size = encoder.encode_ended(texts.slice(lo, hi - lo), end_id)
                wide = ids.max(initial=0) > 0xFFFF
                mark, raw = (b"\4", memoryview(ids.tobytes())) if wide else (b"\2", memoryview(ids.astype("<u2").tobytes()))
                width, whole = 4 if wide else 2, memoryview(ids.tobytes())
                cut = np.concatenate(([0], np.cumsum(size))).tolist()
                yield out_batch(schema, {
                    "_doc": docs_.slice(lo, hi - lo), "_n": size,
                    "_crc": [zlib.crc32(whole[4 * a: 4 * b]) for a, b in zip(cut, cut[1:])],
                    "_ids": [mark + raw[width * a: width * b] for a, b in zip(cut, cut[1:])]})

    return map_arrow(rows, run, f"_doc {dict(rows.dtypes)['_doc']}, _n long, _crc long, _ids binary")


def unpack(packed: bytes) -> np.ndarray:
    """The ids of a stored document: a first byte 2 or 4 says how many bytes each takes."""
    return np.frombuffer(packed, "<u4" if packed[0] == 4 else "<u2", offset=1)


def id_counts(tokens: DataFrame) -> DataFrame:
    """``(id, n)`` over all documents; each task sends a row per id at most once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            held = batch.column(0)
            for lo, hi in slices(held):
                c = np.bincount(np.concatenate([unpack(v) for v in held.slice(lo, hi - lo).to_pylist()]))
                if len(c) > len(total):
                    total = np.concatenate((total, np.zeros(len(c) - len(total), np.int64)))
                total[: len(c)] += c
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())],
                                         names=["id", "n"])

    return map_arrow(tokens.select("_ids"), run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_files(tokens: DataFrame, path: str) -> None:
    """Write ``token_rows`` (a stored table: it is read twice) as a file set."""
    spark = tokens.sparkSession
    counts = id_counts(tokens)
    rows = counts.limit(MAX_VOCABULARY + 1).collect()  # one row per vocabulary entry
    if len(rows) > MAX_VOCABULARY:
        raise ValueError("the vocabulary is larger than the codebook's bound")
    n = np.zeros(max([r["id"] for r in rows], default=0) + 1, np.int64)
    for r in rows:
        n[r["id"]] = r["n"]
    lengths = code_lengths(n, max(MAX_BITS, int(np.ceil(np.log2(max(2, len(rows)))))))
    book = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(book, "id long, bits int").coalesce(1).write.parquet(f"{path}/codebook")
    codes = canonical_codes(lengths)
    doc_type = dict(tokens.dtypes)["_doc"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, before = TaskContext.get().partitionId(), 0, 0
        held: list[np.ndarray] = []
        held_docs: list = []
        size = 0
        kind = None

        def flush() -> pa.RecordBatch:
            nonlocal block, before, size
            payload, marks = encode_block(np.concatenate(held), lengths, codes)
            out = pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([before], pa.int64()),
                pa.array([held_docs], pa.list_(kind)),
                pa.array([[len(h) for h in held]], pa.list_(pa.int64())),
                pa.array([payload], pa.binary()), pa.array([marks.tolist()], pa.list_(pa.int64()))],
                names=["part", "block", "before", "docs", "lengths", "payload", "checkpoints"])
            block, before, size = block + 1, before + size, 0
            held.clear()
            held_docs.clear()
            return out

        for batch in batches:
            kind = batch.column(0).type
            for k in range(len(batch)):
                ids = unpack(batch.column(1)[k].as_py())
                held.append(ids)
                held_docs.append(batch.column(0)[k].as_py())
                size += len(ids)
                if size >= BLOCK_IDS:
                    yield flush()
        if held:
            yield flush()

    # Rows of one id (or of none) may be many: length and checksum spread them over ranges as well.
    ordered = tokens.repartitionByRange("_doc", "_n", "_crc").sortWithinPartitions("_doc", "_n", "_crc")
    (map_arrow(ordered.select("_doc", "_ids"), run,
               f"part int, block int, before long, docs array<{doc_type}>, lengths array<long>, "
               "payload binary, checkpoints array<long>")
     .write.option("compression", "none").parquet(f"{path}/blocks"))


def read_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) of a file set."""
    book = spark.read.parquet(f"{path}/codebook").collect()  # one row per vocabulary entry
    lengths = np.zeros(max([r["id"] for r in book], default=0) + 1, np.int64)
    for r in book:
        lengths[r["id"]] = r["bits"]
    blocks = spark.read.parquet(f"{path}/blocks")
    doc_type = dict(blocks.dtypes)["docs"][6:-1]
    codes = canonical_codes(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder, top = decode_table(lengths, codes)
        for batch in batches:
            for k in range(len(batch)):
                part, before, docs, sizes, payload, marks = (batch.column(j)[k] for j in range(6))
                sizes = np.array(sizes.as_py(), np.int64)
                ids = decode_block(payload.as_py(), np.array(marks.as_py(), np.int64), int(sizes.sum()),
                                   decoder, top).astype("<u4")
                ends = np.cumsum(sizes)
                raw = memoryview(ids.tobytes())
                each = [raw[4 * (e - s): 4 * e] for s, e in zip(sizes.tolist(), ends.tolist())]
                cols = [pa.array([part.as_py()] * len(sizes), pa.int32()), docs.values.slice(0),
                        pa.array(before.as_py() + ends - sizes, pa.int64()), pa.array(sizes, pa.int64()),
                        pa.array([zlib.crc32(x) for x in each], pa.int64())]
                names = ["part", "doc_id", "inside", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([np.frombuffer(x, "<u4").astype(np.int64).tolist() for x in each],
                                         pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = f"part int, doc_id {doc_type}, inside long, n_tokens long, ids_crc32 long"
    rows = map_arrow(
        blocks.select("part", "before", "docs", "lengths", "payload", "checkpoints"), run, schema + (", ids array<long>" if with_ids else ""))
    # One row per part of the file set (its number of range partitions), summed over the parts before.
    totals = blocks.groupBy("part").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"),
                                                          lambda a, x: a + x)).alias("_ids"))
    offsets = totals.select(F.col("part").alias("_part"), (F.sum("_ids").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).alias("_offset"))
    return rows.join(F.broadcast(offsets), F.col("part") == F.col("_part")).select(
        "doc_id", (F.coalesce("_offset", F.lit(0)) + F.col("inside")).alias("start"), "n_tokens",
        "ids_crc32", *(["ids"] if with_ids else []))


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 2, path: str | None = None) -> DataFrame:
    """Encode ``docs`` into a file set at ``path`` (a fresh shared folder by default) and read it."""
    spark = docs.sparkSession
    path = path or f"{work_dir(spark)}/token_file"
    write_files(staged(token_rows(docs, tokenizer_path, end_id), "tokens"), path)
    return read_files(spark, path)
