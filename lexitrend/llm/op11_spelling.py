"""Spelling variants: words that are one edit apart, by dense prefix-suffix tiling.

Two words of which the longer has M code points differ by exactly one inserted, deleted or replaced
code point if and only if they are not equal and the length of their common prefix plus that of
their common suffix reaches M - 1. Blocks of words are laid out as padded code-point matrices, once
aligned to the left and once to the right, and a block is compared with another column by column.

Which blocks meet: the place of the edit lies in some piece of the longer word, and all code points
before and after that piece agree. So a word is dealt, for M = its length and its length + 1 and for
either half of the M places, to the block of words that agree with it outside that half. A block of
more than ``MAX_BLOCK`` words is dealt again by the two halves of its piece, and so on; with a piece
of one place a block has at most one word per letter and one shorter word. Blocks are therefore
bounded without a cap, no pair is lost, and a pair is reported by the one block whose piece holds the
first place its edit can have. Counting words is partial per task; a very frequent word is one row
per task, a block one small group.

Results that are fixed here:

- a null text has no words; a null id counts as empty text in the rule that picks runs;
- repeated rows count as often as they occur; further columns do not matter; no rows, no result;
- of several near words with the largest count the smallest in code-point order is the form.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import look_up, map_arrow, slices, staged

MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
#: Every so many-th run, by its hash, loses one code point.
HASH_STEP = 31
#: Words of a block that are compared with one another; larger blocks are dealt by smaller pieces.
MAX_BLOCK = 128
#: Different words that a counting task gathers before it gives them on.
GATHER = 400_000
#: Pairs of words (or cells of a matrix) that one comparison handles (bounds a task's memory).
TILE_PAIRS = 1 << 18

#: Letters (A-Z, a-z, U+00C0 to U+00FF) as bytes of Latin-1, A-Z in lower case; all else a blank.
_RUNS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def spelled(text: str, id_text: str, min_length: int = MIN_LENGTH) -> Counter:
    """Counts of a text's words (as Latin-1 bytes) of at least ``min_length`` code points, after the
    rule that takes a code point out of some runs."""
    runs = Counter(w for w in text.encode("latin-1", "replace").translate(_RUNS).split() if len(w) >= min_length)
    start = zlib.crc32(f"{id_text}:".encode())
    out = Counter()
    for w, n in runs.items():
        h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
        if h % HASH_STEP == 0:
            at = h % len(w)
            w = w[:at] + w[at + 1:]
            if len(w) < min_length:
                continue
        out[w] += n
    return out


def words_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
             min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)`` of all words that occur at least ``min_count`` times in all."""

    def rows(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([w.decode("latin-1") for w in total], pa.string()), pa.array(total.values(), pa.int64())],
            names=["word", "n"])

    def count(batches):
        total = Counter()
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                ids, texts = (batch.column(k).slice(lo, hi - lo).to_pylist() for k in (0, 1))
                for i, t in zip(ids, texts):
                    if t:
                        total.update(spelled(t, i, min_length))
                    if len(total) >= GATHER:
                        yield rows(total)
                        total = Counter()
        if total:
            yield rows(total)

    parts = map_arrow(docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"),
                                  F.col(text_col).cast("string").alias("_text")), count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _dealt(rows: DataFrame) -> DataFrame:
    """``rows`` (word, n, size: code points, longer: M, lo, hi: the piece) with the block's key."""
    after = F.col("hi") - (F.col("longer") - F.col("size"))   # where the piece ends in this word
    return rows.withColumn("block", F.xxhash64(
        "longer", "lo", "hi", F.expr("substring(word, 1, lo)"), F.col("word").substr(after + 1, F.col("size") - after)))


def _halves(rows: DataFrame) -> DataFrame:
    """Each row once per half of its piece (a piece of one place has no halves)."""
    mid = F.expr("(lo + hi) div 2").cast("int")
    both = F.array(F.struct(F.col("lo").alias("a"), mid.alias("b")), F.struct(mid.alias("a"), F.col("hi").alias("b")))
    return rows.withColumn("_half", F.explode(both)).filter("_half.a < _half.b").select(
        "word", "n", "size", "longer", F.col("_half.a").alias("lo"), F.col("_half.b").alias("hi"))


def blocks(words: DataFrame, max_block: int = MAX_BLOCK) -> DataFrame:
    """Every word's rows ``(block, longer, lo, hi, word, n)`` in blocks of at most ``max_block``
    words (more only where a piece is one place long)."""
    sized = words.withColumn("size", F.length("word").cast("int")).withColumn(
        "longer", F.explode(F.array(F.col("size"), F.col("size") + 1)))
    todo, done = _dealt(_halves(sized.withColumns({"lo": F.lit(0), "hi": F.col("longer")}))), None
    while True:
        large = staged(todo.filter("hi - lo > 1").groupBy("block").agg(F.count(F.lit(1)).alias("_n"))
                       .filter(F.col("_n") > max_block).select(F.col("block").alias("_large")), "large_blocks")
        if large.isEmpty():
            return todo if done is None else done.unionByName(todo)
        marked = look_up(todo, large.withColumn("_hit", F.lit(True)), {"block": "_large"}, F.col("word"))
        small = marked.filter("_hit is null or hi - lo = 1").select(*todo.columns)
        done = small if done is None else done.unionByName(small)
        todo = staged(_dealt(_halves(marked.filter("_hit and hi - lo > 1"))), "block_rows")


def matrices(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, padded with 0, aligned to the left and to the right."""
    left = np.array(words, f"U{width}").view(np.uint32).reshape(len(words), width)
    size = np.fromiter(map(len, words), np.int64, len(words))
    at = np.arange(width)[None, :] - (width - size)[:, None]
    right = np.where(at >= 0, np.take_along_axis(left, np.maximum(at, 0), 1), 0)
    return left, right


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For stacks of blocks ``a`` (g, x, width) and ``b`` (g, y, width): the lengths of the common
    beginnings of all rows, (g, x, y), compared column by column."""
    run = np.ones((a.shape[0], a.shape[1], b.shape[1]), bool)
    total = np.zeros(run.shape, np.int32)
    for k in range(a.shape[2]):
        run &= a[:, :, None, k] == b[:, None, :, k]
        if not run.any():
            break
        total += run
    return total


def tile(left: np.ndarray, right: np.ndarray, size: np.ndarray, longer: int, lo: int, hi: int
         ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs ``(block, i, j)`` one edit apart in a stack of blocks (g, x, width) with sizes (g, x; 0
    for padding), whose longer word has ``longer`` code points and whose edit's first possible place
    is in ``[lo, hi)``. ``i`` is a word of that length."""
    prefix = common(left, left)
    suffix = common(right[:, :, ::-1], right[:, :, ::-1])
    x = size[:, :, None]
    y = size[:, None, :]
    short = np.minimum(x, y)
    prefix = np.minimum(prefix, short)
    suffix = np.minimum(suffix, short)
    place = np.maximum(0, longer - 1 - suffix)
    index = np.arange(size.shape[1])
    same = (x == longer) & (y == longer) & (index[:, None] < index[None, :])
    near = (same | ((x == longer) & (y == longer - 1))) & (prefix + suffix >= longer - 1) & (
        place >= lo) & (place < hi)
    return np.nonzero(near)


def _stacks(words: list[str], keys: np.ndarray):
    """Stacks of blocks of like shape: rows of the batch as an index matrix (g, x), padded with -1."""
    edge = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1), True])
    first, count = edge[:-1], np.diff(edge)
    some = count > 1
    first, count = first[some], count[some]
    shape = np.ceil(np.log2(np.maximum(count, 2))).astype(int)
    tag = np.c_[shape, keys[first][:, 1:]] if len(first) else np.empty((0, 4), np.int64)
    order = np.lexsort(tag.T[::-1]) if len(first) else np.empty(0, int)
    starts = np.flatnonzero(np.r_[True, (tag[order][1:] != tag[order][:-1]).any(1)]) if len(order) else []
    for a, b in zip(starts, [*starts[1:], len(order)] if len(order) else []):
        part = order[a:b]
        x = int(count[part].max())
        step = max(1, TILE_PAIRS // (x * max(x, int(tag[part[0]][1]))))
        for lo in range(0, len(part), step):
            own = part[lo:lo + step]
            at = first[own][:, None] + np.arange(x)[None, :]
            yield np.where(np.arange(x)[None, :] < count[own][:, None], at, -1), tag[own[0]][1:]


def near_words(words: DataFrame, max_block: int = MAX_BLOCK) -> DataFrame:
    """Of ``(word, n)``: ``(word, n_near, top)`` for words with a near word; ``top`` is
    ``struct(minus, near)``, minus the largest count among them and the word that has it."""
    # A row's block is whole in its task: blocks are small, so hashing them to tasks is even.
    dealt = blocks(words, max_block).select("block", F.col("longer").cast("long"), F.col("lo").cast("long"),
                                            F.col("hi").cast("long"), "word", "n")
    dealt = dealt.repartition("block").sortWithinPartitions("block", "longer", "lo", "hi")

    def compare(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            key = table.column("block").to_numpy()
            last = _tail(key)
            held = table.slice(last).to_batches()[0] if last < len(key) else None
            if last:
                yield from found(table.slice(0, last))
        if held is not None:
            yield from found(pa.Table.from_batches([held]))

    def found(rows: pa.Table):
        keys = np.stack([rows.column(c).to_numpy() for c in ("block", "longer", "lo", "hi")], axis=1)
        words, n = rows.column("word").to_pylist(), rows.column("n").to_numpy()
        size = np.fromiter(map(len, words), np.int64, len(words))
        one, two = [], []
        for at, (longer, lo, hi) in _stacks(words, keys):
            there = at >= 0
            left, right = matrices([words[i] if i >= 0 else "" for i in at.ravel()], int(longer))
            shape = (*at.shape, int(longer))
            g, i, j = tile(left.reshape(shape), right.reshape(shape), np.where(there, size[at], 0),
                           int(longer), int(lo), int(hi))
            one += [at[g, i], at[g, j]]
            two += [at[g, j], at[g, i]]
        if one:
            a, b = np.concatenate(one), np.concatenate(two)
            take = rows.column("word").combine_chunks()
            yield pa.RecordBatch.from_arrays([take.take(pa.array(a)), take.take(pa.array(b)), pa.array(n[b])],
                                             names=["word", "near", "near_n"])

    pairs = map_arrow(dealt, compare, "word string, near string, near_n long")
    return pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct(
        (-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("top"))


def _tail(key: np.ndarray) -> int:
    """Where the last run of equal keys begins."""
    other = np.flatnonzero(key != key[-1])
    return int(other[-1]) + 1 if len(other) else 0


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``(word, form)``: forms followed to the last one. Each round doubles the
    length of the chains that are followed; counts grow tenfold along a chain, so few rounds do."""
    known = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        after = known.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        known = staged(known.join(after, F.col("root") == F.col("_w"), "left").select(
            "word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")), "roots")
        if known.filter("moved").isEmpty():
            return known.select("word", "root")
        known = known.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_block: int = MAX_BLOCK) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``docs``."""
    words = staged(words_of(docs, id_col, text_col), "words")
    near = near_words(words, max_block)
    formed = staged(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("top.minus") >= RATIO * F.col("n"), F.struct("top.near", "top.minus")).alias("_f")).select(
        "word", F.col("_f.near").alias("form"), "n", "n_near", (-F.col("_f.minus")).alias("form_n")), "forms")
    last = roots(formed.filter("form is not null")).withColumnRenamed("word", "_word")
    return formed.join(last, F.col("word") == F.col("_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
