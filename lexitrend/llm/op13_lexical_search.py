"""Ranked lexical search: exact inner-product search in sparse ball trees.

A document is a sparse vector with one entry per term, the term's weight times its saturated
frequency, all in whole numbers; an item is the vector of its term counts; the score is their inner
product. Only terms of the searched items can add to a score, so documents are projected onto them.

Documents are dealt to tasks in ranges of their heaviest terms, so that a task's documents are
alike, and each task builds ball trees of up to ``TREE_ROWS`` documents: a node has a centroid and a
radius, the greatest distance of its documents from it, and is split across the line between two far
documents. No document below a node can score more than ``q.c + |q| R``. The nodes of all trees of a
task are searched best-first for each item: a node is opened only while its bound is not below the
tenth score found so far, and documents of opened leaves are scored exactly in 64-bit integers.
Bounds are safe against rounding: every term is non-negative or a sum of squares of differences, so
its relative error is at most its number of additions times the machine epsilon, by which it is
raised. Each task gives at most ten documents an item; they meet in salted top-ten windows.

Statistics (N, L, df) are Spark aggregates over all documents. Items are searched in blocks of
``BLOCK_ITEMS``, one pass over the documents per block: a block's items and the weights of their
terms are what reaches the driver and the tasks.

Results that are fixed here:

- a null or empty text, or one without terms, is no document of N and is never returned;
- an item without terms, or none of whose terms occurs, has no rows; every item row is an item of
  its own (rows that repeat an id are ranked one by one);
- equal scores are ranked by ascending id, null ids last; repeated rows are documents of their own;
- empty tables give an empty result; further columns do not matter.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, slices, staged

TOP_K = 10
#: Fixed values of the ranking: thousandths of a weight, saturation and length normalisation.
WEIGHT_SCALE, TF_SCALE, TF_STEP, LENGTH_STEP, LENGTH_SHARE = 1000, 1_000_000_000, 1000, 8, 75
#: Items that are searched in one pass over the documents.
BLOCK_ITEMS = 1024
#: Documents of a tree and of a leaf; cells of a tree's dense working matrix.
TREE_ROWS, LEAF_ROWS, TREE_CELLS = 512, 32, 1 << 21
#: Salts of the first of the two windows that merge the tasks' results.
SALTS = 64
_EPS = 2.0 ** -52

#: Bytes of UTF-8: letters and digits of ASCII (A-Z in lower case) and all bytes of other code
#: points belong to terms, the rest becomes a blank.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 0x80 else 32
               for c in range(256))


def terms(raw: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return raw.translate(_TERMS).split()


@dataclass(frozen=True)
class Items:
    """A block of items: the numbers and counts of their terms."""

    vocabulary: dict[bytes, int]
    numbers: list[np.ndarray]
    counts: list[np.ndarray]

    @classmethod
    def of(cls, texts: list[str | None]) -> Items:
        vocabulary: dict[bytes, int] = {}
        numbers, counts = [], []
        for text in texts:
            own = Counter(terms((text or "").encode("utf-8", "surrogatepass")))
            numbers.append(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in own], np.int64))
            counts.append(np.array(list(own.values()), np.int64))
        return cls(vocabulary, numbers, counts)


def vectors(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(_id, _n, _terms, _tf)`` of every document with a term: its id, its number of terms, and the
    vocabulary's terms in it with their counts."""
    names = ["_id", "_n", "_terms", "_tf"]
    kind = docs.schema[id_col].dataType

    def run(batches):
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                length, owner, number, count = [], [], [], []
                for k, raw in enumerate(batch.column(1).slice(lo, hi - lo).cast(pa.binary()).to_pylist()):
                    words = terms(raw or b"")
                    if not words:
                        continue
                    own = sorted((vocabulary[w], n) for w, n in Counter(words).items() if w in vocabulary)
                    owner.append(k)
                    length.append(len(words))
                    number.append([x[0] for x in own])
                    count.append([x[1] for x in own])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo).take(pa.array(owner, pa.int64())), pa.array(length, pa.int64()),
                     pa.array(number, pa.list_(pa.int32())), pa.array(count, pa.list_(pa.int64()))], names=names)

    schema = T.StructType([T.StructField("_id", kind), T.StructField("_n", T.LongType()), T.StructField(
        "_terms", T.ArrayType(T.IntegerType())), T.StructField("_tf", T.ArrayType(T.LongType()))])
    return map_arrow(docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")), run, schema)


def weight(n_docs: int, df: int) -> int:
    """A term's weight in a corpus of ``n_docs`` documents, ``df`` of which hold it."""
    return math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass(frozen=True)
class Statistics:
    """N, L and the weight of each number of the vocabulary."""

    n_docs: int
    n_terms: int
    weights: np.ndarray

    @classmethod
    def of(cls, rows: DataFrame, size: int) -> Statistics:
        """Over all document vectors; one number per term of the searched items reaches the driver."""
        n_docs, n_terms = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("_n"), F.lit(0))).first()
        weights = np.zeros(size, np.int64)
        for r in rows.select(F.explode("_terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():
            weights[r["t"]] = weight(n_docs, r["df"])
        return cls(n_docs, n_terms, weights)

    def norms(self, n: np.ndarray) -> np.ndarray:
        """The length norm m of documents with ``n`` terms."""
        if len(n) and int(n.max()) * self.n_docs * LENGTH_SHARE >= 1 << 62:     # beyond 64 bits: Python's integers
            return np.array([100 - LENGTH_SHARE + LENGTH_SHARE * int(x) * self.n_docs // self.n_terms for x in n], np.int64)
        return 100 - LENGTH_SHARE + LENGTH_SHARE * n * self.n_docs // self.n_terms

    def entries(self, owner: np.ndarray, n: np.ndarray, number: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """The vectors' entries: weight times saturated frequency."""
        return self.weights[number] * (TF_SCALE * tf // (TF_STEP * tf + LENGTH_STEP * self.norms(n)[owner]))


@dataclass
class Tree:
    """A ball tree over a task's slice of documents: their entries by term (``dense``: one row per
    term that occurs, ``place`` gives a term's row), nodes with the range of documents below them."""

    ids: list
    place: np.ndarray
    dense: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    child: np.ndarray
    centres: np.ndarray
    radius: np.ndarray

    @classmethod
    def of(cls, ids: list, owner: np.ndarray, number: np.ndarray, entry: np.ndarray, size: int) -> Tree:
        used = np.unique(number)
        place = np.full(size, -1, np.int64)
        place[used] = np.arange(len(used))
        rows = np.zeros((len(ids), len(used)))
        rows[owner, place[number]] = entry                    # below 2**53, so exact
        order, nodes = np.arange(len(ids)), []

        def grow(lo: int, hi: int) -> int:
            own = rows[order[lo:hi]]
            centre = own.mean(0)
            away = ((own - centre) ** 2).sum(1)
            far = float(away.max()) if hi > lo else 0.0
            at = len(nodes)
            nodes.append([lo, hi, -1, centre, math.sqrt(far) * (1 + (len(used) + 8) * _EPS)])
            if hi - lo > LEAF_ROWS and far > 0:
                a = own[int(away.argmax())]
                b = own[int(((own - a) ** 2).sum(1).argmax())]
                side = np.argsort(own @ (b - a), kind="stable")
                order[lo:hi] = order[lo:hi][side]
                mid = (lo + hi) // 2
                left = grow(lo, mid)
                right = grow(mid, hi)
                nodes[at][2] = (left, right)
            return at

        grow(0, len(ids))
        dense = np.ascontiguousarray(rows[order].T).astype(np.int64)
        return cls([ids[i] for i in order], place, dense, np.array([x[0] for x in nodes]), np.array([x[1] for x in nodes]),
                   np.array([(-1, -1) if x[2] == -1 else x[2] for x in nodes]), np.stack([x[3] for x in nodes], axis=1),
                   np.array([x[4] for x in nodes]))

    def bounds(self, number: np.ndarray, count: np.ndarray) -> np.ndarray:
        """For each node, a number no document below it can exceed in score."""
        at = self.place[number]
        seen = at >= 0
        slack = 1 + (len(number) + 8) * _EPS
        dot = count[seen].astype(float) @ self.centres[at[seen]] if seen.any() else np.zeros(len(self.radius))
        size = math.sqrt(float((count[seen].astype(float) ** 2).sum())) * slack
        return np.nextafter((dot * slack + size * self.radius * slack) * (1 + 4 * _EPS), np.inf)

    def score(self, node: int, number: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The scores of the documents of a leaf."""
        at = self.place[number]
        seen = at >= 0
        return count[seen] @ self.dense[at[seen], self.lo[node]:self.hi[node]]


class Best:
    """The best ``k`` documents so far: highest score, then smallest id (null last)."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    def least(self) -> int:
        """No document below this score can enter."""
        return self.rows[-1][0] if len(self.rows) == self.k else 1

    def add(self, scores: np.ndarray, ids: list) -> None:
        new = [(int(scores[i]), ids[i]) for i in np.flatnonzero(scores >= self.least())]
        if new:
            self.rows = sorted(self.rows + new, key=lambda r: (-r[0], r[1] is None, r[1] if r[1] is not None else 0))[:self.k]


def search(trees: list[Tree], number: np.ndarray, count: np.ndarray, best: Best) -> int:
    """Best-first over the nodes of all ``trees``; returns how many documents were scored."""
    scored = 0
    bounds = [tree.bounds(number, count) for tree in trees]
    heap = [(-float(b[0]), t, 0) for t, b in enumerate(bounds)]
    heapq.heapify(heap)
    while heap and -heap[0][0] >= best.least():
        _, t, node = heapq.heappop(heap)
        tree = trees[t]
        if tree.child[node][0] < 0:
            best.add(tree.score(node, number, count), tree.ids[tree.lo[node]:tree.hi[node]])
            scored += int(tree.hi[node] - tree.lo[node])
        else:
            for c in tree.child[node]:
                heapq.heappush(heap, (-float(bounds[t][c]), t, int(c)))
    return scored


#: Trees that a task keeps open for one search.
TASK_TREES = 8


def _trees(batches: Iterator[pa.RecordBatch], stats: Statistics, size: int) -> Iterator[Tree]:
    """Trees over a task's documents in their order, of bounded working size."""
    limit = max(LEAF_ROWS, min(TREE_ROWS, TREE_CELLS // max(1, size)))
    for batch in batches:
        for lo in range(0, batch.num_rows, limit):
            part = batch.slice(lo, limit)
            ids, n = part.column(0).to_pylist(), part.column(1).to_numpy()
            lists = part.column(2)
            owner = np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
            number, tf = lists.flatten().to_numpy().astype(np.int64), part.column(3).flatten().to_numpy()
            yield Tree.of(ids, owner, number, stats.entries(owner, n, number, tf), size)


def _heaviest(rows: DataFrame, stats: Statistics) -> DataFrame:
    """``rows`` with ``_lead``: their three heaviest terms, by which alike documents come together."""

    def run(batches):
        for batch in batches:
            n, lists = batch.column(1).to_numpy(), batch.column(2)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            number, tf = lists.flatten().to_numpy().astype(np.int64), batch.column(3).flatten().to_numpy()
            entry = stats.entries(owner, n, number, tf)
            order = np.lexsort((number, -entry, owner))
            first = np.searchsorted(owner[order], np.arange(batch.num_rows))
            lead = np.full((batch.num_rows, 3), -1, np.int64)
            for k in range(3):
                at = np.minimum(first + k, len(order) - 1)
                own = owner[order[at]] == np.arange(batch.num_rows) if len(order) else np.zeros(batch.num_rows, bool)
                lead[own, k] = number[order[at[own]]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(lead[:, k]) for k in range(3))],
                                             names=[*batch.schema.names, "_a", "_b", "_c"])

    schema = T.StructType([*rows.schema.fields, *(T.StructField(c, T.LongType()) for c in ("_a", "_b", "_c"))])
    return map_arrow(rows, run, schema)


def top_documents(rows: DataFrame, items: Items, stats: Statistics, k: int = TOP_K) -> DataFrame:
    """``(_item, doc_id, score)``: each item's ``k`` best of every task's documents, from document
    vectors with the vocabulary's terms (``rows``)."""
    size = len(items.vocabulary)
    kind = rows.schema["_id"].dataType

    def run(batches):
        best = [Best(k) for _ in items.numbers]

        def look(trees: list[Tree]) -> None:
            for number, count, own in zip(items.numbers, items.counts, best):
                search(trees, number, count, own)

        trees = []
        for tree in _trees(batches, stats, size):
            trees.append(tree)
            if len(trees) == TASK_TREES:
                look(trees)
                trees = []
        look(trees)
        out = [(i, d, s) for i, own in enumerate(best) for s, d in own.rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], _arrow(kind)),
             pa.array([x[2] for x in out], pa.int64())], names=["_item", "doc_id", "score"])

    # Rows of one range differ in _at at least, so no group of like documents fills a range alone.
    ranged = _heaviest(rows.filter("size(_terms) > 0"), stats).withColumn("_at", F.monotonically_increasing_id())
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = staged(ranged, "vectors").repartitionByRange(parts, "_a", "_b", "_c", "_at").sortWithinPartitions(
        "_a", "_b", "_c", "_at").select("_id", "_n", "_terms", "_tf")
    schema = T.StructType([T.StructField("_item", T.IntegerType()), T.StructField("doc_id", kind),
                           T.StructField("score", T.LongType())])
    return map_arrow(near, run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def ranked(found: DataFrame, k: int = TOP_K) -> DataFrame:
    """The ``k`` best rows of each item, with ``rank``: first within salts, then of what is left."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salt = F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS))
    some = found.withColumn("_salt", salt).withColumn("_k", F.row_number().over(
        Window.partitionBy("_item", "_salt").orderBy(*order))).filter(F.col("_k") <= k).drop("_salt", "_k")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("_item").orderBy(*order)).cast("int")).filter(
        F.col("rank") <= k)


def search_all(docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text", k: int = TOP_K,
               block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` best documents of every row of ``queries``."""
    spark = docs.sparkSession
    listed = staged(queries.select(F.col(item_col).alias("item_id"), F.col(item_text).cast("string").alias("_text")), "items")
    out, block = None, []

    def flush() -> DataFrame:
        items = Items.of([r["_text"] for r in block])
        rows = staged(vectors(docs, items.vocabulary, id_col, text_col), "terms")
        found = ranked(top_documents(rows, items, Statistics.of(rows, len(items.vocabulary)), k), k)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(block)], T.StructType(
            [T.StructField("_number", T.IntegerType()), listed.schema["item_id"]]))
        return found.join(F.broadcast(names), F.col("_item") == F.col("_number")).select(
            "item_id", "rank", "doc_id", "score")

    for row in listed.toLocalIterator():                  # one block of items at a time on the driver
        block.append(row)
        if len(block) == block_items:
            part, block = staged(flush(), "found"), []
            out = part if out is None else out.unionByName(part)
    if block or out is None:
        part = flush()
        out = part if out is None else out.unionByName(part)
    return out


ORACLE = r"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
q AS (SELECT item_id, t, count(*) AS c FROM (SELECT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark) GROUP BY 1, 2),
len AS (SELECT doc_id, count(*) AS n FROM d GROUP BY 1),
total AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM len),
tf AS (SELECT doc_id, t, count(*) AS tf FROM d WHERE t IN (SELECT t FROM q) GROUP BY 1, 2),
w AS (SELECT t, CAST(floor(1000 * ln((2 * max(nn) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY 1),
x AS (SELECT tf.doc_id, tf.t, w.w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * nn) // ll)))) AS x
      FROM tf JOIN w USING (t) JOIN len USING (doc_id), total),
s AS (SELECT item_id, doc_id, CAST(sum(c * x) AS BIGINT) AS score FROM q JOIN x USING (t) GROUP BY 1, 2)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM s WHERE score > 0) WHERE r <= 10
"""
