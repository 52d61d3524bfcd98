"""Near-duplicate classes by ProbMinHash, banding and verification.

A text is the weighted set of its shingles (five successive lower-case words; weight 1 + ln of
how often one occurs). ProbMinHash estimates the probability Jaccard similarity of two such
sets: every shingle sends a Poisson process of arrivals, at a rate of its weight, to random
components of the signature, each component keeps its earliest arrival, and a shingle stops as
soon as its next arrival is later than every component's. All shingles of a slice of texts take
their first arrivals together, then their second, and so on (numpy).

Texts with equal shingle sets are one *text* from then on. Texts that agree on all rows of a
band share a bucket. Links are found in two rounds, so that a bucket never emits all pairs:

1. every text is compared with the least text of each of its buckets, and verified links are
   joined to components;
2. components that still share a bucket and hold a pair with an estimate not far below the
   threshold form a cluster. In each cluster the texts outside its largest component are compared
   with all texts of other components, in pairs of blocks of bounded size; a task emits a link
   only if it joins two components, so never all pairs.

Verification computes the exact probability Jaccard of two whole texts. Pairs inside one
component need no comparison, so no link between classes is lost to the saving. The chance that
a pair at similarity 0.8 shares none of the 40 bands of 6 rows is 5e-6.

Results that are fixed here:

- a class is a connected component of links of at least ``THRESHOLD``; its id is the smallest
  ``doc_id``, whose row (one of them, if repeated) is kept; null ids are smaller than all;
- a text of fewer than five words is one shingle of all its words; texts without any word (empty
  and null ones too, null counting as empty) are alike only if they are identical;
- ``keep_one`` keeps exactly one row of each class, whatever the ids: repeated rows with one id or none too;
- repeated rows are classed like any others; an empty table gives an empty result; further
  columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from .common import hot_keys, look_up, map_arrow, mix64, slices, split_join, staged, texts_of, word_hashes
from .components import components

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 40, 6
#: Second round: signatures and characters of text of a block, and the estimate from which on two
#: texts put their components into one cluster (0.8 is five standard errors above it).
BLOCK, BLOCK_CHARS, DISCARD = 512, 1_000_000, 0.67
_GOLD = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xA0761D6478BD642F)


def shingles(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, shingle, weight)`` sorted by text and shingle, each once."""
    h, doc = word_hashes(texts)
    n = len(h)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0)
    size = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(size) - size
    inside = np.arange(n) - first[doc]
    short = size[doc] < words
    value = np.zeros(n, np.uint64)
    padded = np.concatenate((h, np.zeros(words, np.uint64)))
    for k in range(words):
        there = ~short | (inside + k < size[doc])
        value = mix64(value * np.uint64(3) + np.where(there, padded[k: n + k], np.uint64(k + 1)))
    keep = np.where(short, inside == 0, inside <= size[doc] - words)
    doc, value = doc[keep], value[keep]
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    start = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])])
    count = np.diff(np.r_[start, len(doc)])
    return doc[start], value[start], 1.0 + np.log(count)


def prob_min_hash(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, m: int) -> np.ndarray:
    """Signatures (``n`` by ``m``; the winning shingle of each component, 0 without shingles)."""
    earliest = np.full(n * m, np.inf)
    winner = np.zeros(n * m, np.uint64)
    time, rate = np.zeros(len(doc)), 1.0 / weight
    latest = np.full(n, np.inf)
    step = 0
    while len(doc):
        seed = mix64(shingle + np.uint64((_GOLD * (2 * step + 1)) & (1 << 64) - 1))
        wait = -np.log(((seed >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0 ** -53)
        time = time + wait * rate
        go = time < latest[doc]
        if not go.all():
            doc, shingle, rate, time, seed = doc[go], shingle[go], rate[go], time[go], seed[go]
        component = ((mix64(seed + _STEP) >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        slot = doc * m + component
        np.minimum.at(earliest, slot, time)
        won = earliest[slot] == time
        winner[slot[won]] = shingle[won]
        latest = earliest.reshape(n, m).max(1)
        stay = time < latest[doc]
        doc, shingle, rate, time = doc[stay], shingle[stay], rate[stay], time[stay]
        step += 1
    return winner.reshape(n, m)


def probability_jaccard(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """Exact probability Jaccard of two weighted sets (sorted elements ``a``, ``b``)."""
    if not len(a) or not len(b):
        return 0.0
    union = np.union1d(a, b)
    wx, wy = np.zeros(len(union)), np.zeros(len(union))
    wx[np.searchsorted(union, a)] = x
    wy[np.searchsorted(union, b)] = y
    with np.errstate(divide="ignore"):
        ratio = np.where(wy > 0, wx / np.where(wy > 0, wy, 1), np.inf)
    order = np.argsort(ratio, kind="stable")
    wx, wy = wx[order], wy[order]
    above = np.cumsum(wx[::-1])[::-1]            # of this and all larger ratios
    below = np.cumsum(wy) - wy                   # of all smaller ratios
    common = (wx > 0) & (wy > 0)
    return float((1.0 / (above[common] / wx[common] + below[common] / wy[common])).sum())


# --- Spark jobs ------------------------------------------------------------------------------

def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *further: Column) -> DataFrame:
    """``_row, _doc, _k1, _k2, _bands, _sig, _text`` and ``further`` per row; ``_k1, _k2`` name the shingle set."""
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_doc"),
                       F.col(text_col).cast("string").alias("_text"), *further)
    m = BANDS * ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd = np.arange(1, 2 * ROWS, 2, dtype=np.uint64) * np.uint64(_GOLD)
        lane = mix64(np.arange(1, BANDS + 1, dtype=np.uint64))
        for batch in batches:
            texts = batch.column(2)
            for lo, hi in slices(texts):
                held, n = texts_of(texts, lo, hi), hi - lo
                doc, shingle, weight = shingles(held)
                sig = prob_min_hash(doc, shingle, weight, n, m)
                band = mix64((sig.reshape(n, BANDS, ROWS) * odd).sum(2, dtype=np.uint64) ^ lane)
                some = np.bincount(doc, minlength=n) > 0
                # The name of the set: sums over its shingles and weights, so the order is no matter.
                bits = weight.view(np.uint64)
                keys = []
                for salt in (np.uint64(0x51ED270B), np.uint64(0x2545F491)):
                    total = np.zeros(n, np.uint64)
                    np.add.at(total, doc, mix64(shingle ^ mix64(bits + salt)))
                    keys.append(mix64(total + salt))
                for i in np.flatnonzero(~some):
                    raw = held[i].encode("utf-8", "surrogatepass")
                    keys[0][i], keys[1][i] = zlib.crc32(raw), zlib.adler32(raw) << 32 | len(raw)
                offsets = np.concatenate(([0], np.cumsum(np.where(some, BANDS, 0)))).astype(np.int32)
                small = mix64(sig).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, n), batch.column(1).slice(lo, n),
                    pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(band[some].reshape(-1).view(np.int64))),
                    pa.array([r.tobytes() for r in small], pa.binary()),
                    pa.array(held, pa.string()), *[c.slice(lo, n) for c in batch.columns[3:]]],
                    names=["_row", "_doc", "_k1", "_k2", "_bands", "_sig", "_text", *batch.schema.names[3:]])

    schema = StructType([*rows.select("_row", "_doc").schema.fields,
                         *(StructField(c, LongType()) for c in ("_k1", "_k2")),
                         StructField("_bands", ArrayType(LongType())), StructField("_sig", BinaryType()),
                         StructField("_text", StringType()), *rows.schema.fields[3:]])
    return map_arrow(rows, run, schema)


def verified(pairs: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs ``(u, v)`` of ``_row`` ids whose whole texts are at least ``threshold`` alike. A ``u`` may be
    in very many pairs (the least text of large buckets), a ``v`` in one per bucket it is in."""
    a = texts.select(F.col("_row").alias("u"), F.col("_text").alias("_a"))
    b = texts.select(F.col("_row").alias("v"), F.col("_text").alias("_b"))
    hot = hot_keys(pairs.groupBy("u").agg(F.count(F.lit(1)).alias("_n")), ["u"], "_n", pairs.count())
    both = split_join(pairs, a, ["u"], hot, F.col("v")).join(b, "v").select("u", "v", "_a", "_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(2), 500_000):
                held = texts_of(batch.column(2), lo, hi) + texts_of(batch.column(3), lo, hi)
                each = {t: k for k, t in enumerate(dict.fromkeys(held))}
                doc, shingle, weight = shingles(list(each))
                cut = np.searchsorted(doc, np.arange(len(each) + 1))
                like = []
                for k in range(hi - lo):
                    i, j = each[held[k]], each[held[hi - lo + k]]
                    p, q = slice(cut[i], cut[i + 1]), slice(cut[j], cut[j + 1])
                    like.append(probability_jaccard(shingle[p], weight[p], shingle[q], weight[q]) >= threshold - 1e-9)
                keep = pa.array(like, pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(j).slice(lo, hi - lo).filter(keep) for j in (0, 1)], names=["u", "v"])

    return map_arrow(both, run, "u long, v long")


def _dealt(rows: DataFrame, key: str, root: str, blocks: Column) -> DataFrame:
    """Deal the rows of each ``key`` to pairs of blocks ``(_i, _j)``, so that any two rows of
    different roots meet. Only rows outside the key's largest root meet each other and all blocks;
    blocks of the largest root never meet each other, so what is dealt grows with the rows times
    the few blocks of the others. ``blocks`` says, of an aggregate over a root's rows, how many
    blocks they fill."""
    sizes = rows.groupBy(key, root).agg(F.count(F.lit(1)).alias("_n"), blocks.alias("_fill"))
    bulk = sizes.groupBy(key).agg(F.max(F.struct("_n", root, "_fill")).alias("_m"), F.sum("_fill").alias("_all"),
                                  F.count(F.lit(1)).alias("_roots")).filter("_roots > 1").select(
        F.col(key).alias("_key"), F.col(f"_m.{root}").alias("_bulk"),
        F.ceil(F.col("_all") - F.col("_m._fill")).cast("int").alias("_minor_blocks"),
        F.ceil("_m._fill").cast("int").alias("_bulk_blocks"))
    bulk = bulk.withColumns({"_minor_blocks": F.greatest("_minor_blocks", F.lit(1)),
                             "_bulk_blocks": F.greatest("_bulk_blocks", F.lit(1))})
    minor = F.col(root) != F.col("_bulk")
    own = F.when(minor, F.pmod(F.xxhash64("_row"), F.col("_minor_blocks"))).otherwise(
        F.col("_minor_blocks") + F.pmod(F.xxhash64("_row"), F.col("_bulk_blocks"))).cast("int")
    last = F.col("_minor_blocks") + F.col("_bulk_blocks") - 1
    others = F.when(minor, F.sequence(F.lit(0), last)).otherwise(F.sequence(F.lit(0), F.col("_minor_blocks") - 1))
    found = look_up(rows, bulk, {key: "_key"}, F.col("_row")).filter(F.col("_bulk").isNotNull())
    return found.withColumn("_own", own).withColumn(
        "_other", F.explode(others)).withColumns({"_i": F.least("_own", "_other"), "_j": F.greatest("_own", "_other")}
                                                 ).drop("_own", "_other", "_minor_blocks", "_bulk_blocks")


class _Union:
    """Union-find over the roots of one block pair; what it joins is a spanning forest."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def of(self, k: int) -> int:
        while self.up[k] != k:
            self.up[k] = k = self.up[self.up[k]]
        return int(k)

    def all(self) -> np.ndarray:
        while (self.up[self.up] != self.up).any():
            self.up = self.up[self.up]
        return self.up

    def join(self, a: int, b: int) -> bool:
        a, b = self.of(a), self.of(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


_EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _edges(found: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"u": pa.array([u for u, _ in found], pa.int64()), "v": pa.array([v for _, v in found], pa.int64())},
                    schema=_EDGES)


def _near_roots(placed: DataFrame, sigs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(u, v)``: roots that share a bucket and have a pair of rows there whose estimate is
    ``DISCARD`` or more; of each block pair no more edges than join its roots."""
    dealt = _dealt(placed, "_bucket", "_root", F.count(F.lit(1)) / block).join(sigs.select("_row", "_sig"), "_row")

    def compare(group: pa.Table) -> pa.Table:
        names, root = np.unique(group["_root"].to_numpy(), return_inverse=True)
        sig = np.frombuffer(b"".join(group["_sig"].to_pylist()), np.uint8).reshape(len(root), -1)
        most = int(np.bincount(root).argmax())
        union, found = _Union(len(names)), []
        for k in np.flatnonzero(root != most):
            other = np.flatnonzero(union.all()[root] != union.of(root[k]))
            near = other[(sig[other] == sig[k]).mean(1) >= DISCARD] if len(other) else other
            found += [(int(names[root[k]]), int(names[j])) for j in np.unique(root[near]) if union.join(root[k], j)]
        return _edges(found)

    return dealt.groupBy("_bucket", "_i", "_j").applyInArrow(compare, "u long, v long").distinct()


def _exact_links(clusters: DataFrame, threshold: float, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(u, v)``: verified links between rows of different roots in one cluster (columns
    ``_row, _cluster, _root, _text``). Whole texts are compared; rows whose roots a link of the
    same task has already joined are not compared again, so a task emits a spanning forest."""
    dealt = _dealt(clusters, "_cluster", "_root", F.sum(F.length("_text") + 50) / block_chars)

    def compare(group: pa.Table) -> pa.Table:
        row, names = group["_row"].to_numpy(), np.unique(group["_root"].to_numpy())
        root = np.searchsorted(names, group["_root"].to_numpy())
        doc, shingle, weight = shingles([t or "" for t in group["_text"].to_pylist()])
        cut = np.searchsorted(doc, np.arange(len(row) + 1))
        size = np.diff(cut)
        element = np.unique(shingle, return_inverse=True)[1]
        total = np.bincount(doc, weight, len(row))
        share = weight / total[doc]
        plain = np.bincount(doc, weight, len(row)) == size      # no shingle occurs twice
        most = int(np.bincount(root).argmax())
        union, found = _Union(len(names)), []
        own = np.zeros(element.max(initial=-1) + 1)
        for k in np.flatnonzero((root != most) & (size > 0)):
            mine = slice(cut[k], cut[k + 1])
            apart = (union.all()[root] != union.of(root[k])) & (size > 0)
            own[element[mine]] = 1
            common = np.bincount(doc, own[element], len(row))
            like = np.where(apart, common / (size + size[k] - common + (size == 0)), 0.0)
            if not (plain[k] and plain[apart].all()):
                # Weighted sets: the shares in common bound the similarity; those it lets pass are computed.
                own[element[mine]] = share[mine]
                bound = np.bincount(doc, np.minimum(own[element], share), len(row))
                for j in np.flatnonzero(apart & ~(plain & plain[k])):
                    theirs = slice(cut[j], cut[j + 1])
                    like[j] = 0.0 if bound[j] < threshold - 1e-9 else probability_jaccard(
                        shingle[mine], weight[mine], shingle[theirs], weight[theirs])
            own[element[mine]] = 0
            for j in np.flatnonzero(like >= threshold - 1e-9):
                if union.join(root[k], root[j]):
                    found.append((int(row[k]), int(row[j])))
        return _edges(found)

    return dealt.groupBy("_cluster", "_i", "_j").applyInArrow(compare, "u long, v long")


def _links_across(hits: DataFrame, roots: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Verified links between components that share a bucket (see the second round above)."""
    placed = staged(hits.select("_bucket", "_row").join(
        roots.select(F.col("node").alias("_row"), "root"), "_row", "left").select(
        "_bucket", "_row", F.coalesce("root", "_row").alias("_root")), "placed")
    near = components(_near_roots(placed, texts))
    clusters = placed.select("_row", "_root").distinct().join(
        near.select(F.col("node").alias("_root"), F.col("root").alias("_cluster")), "_root").join(
        texts.select("_row", "_text"), "_row")
    return _exact_links(clusters, threshold)


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, class_id, class_size, kept``."""
    classed = _classed(staged(signatures(docs, id_col, text_col), "signatures"), threshold)
    return classed.select(F.col("_doc").alias(id_col), F.col("_least._doc").alias("class_id"),
                          F.col("_size").alias("class_size"), (F.col("_row") == F.col("_least._row")).alias("kept"))


def _classed(table: DataFrame, threshold: float) -> DataFrame:
    """``_row, _doc, _least, _size`` for each row of staged ``signatures``."""
    # Equal sets: the least row stands for all of them.
    heads = table.groupBy("_k1", "_k2").agg(F.min("_row").alias("_head"), F.count(F.lit(1)).alias("_copies"))
    several, n_rows = heads.filter("_copies > 1"), table.count()
    rows = staged(split_join(table.select("_row", "_doc", "_k1", "_k2"), several.drop("_copies"), ["_k1", "_k2"],
                             hot_keys(several, ["_k1", "_k2"], "_copies", n_rows), F.col("_row"), "left").select(
        "_row", "_doc", F.coalesce("_head", "_row").alias("_head")), "rows")
    copies = rows.filter("_row != _head").select("_row")
    bands = table.select("_row", F.explode("_bands").alias("_bucket")).join(copies, "_row", "left_anti")
    shared = staged(bands.groupBy("_bucket").agg(F.min("_row").alias("_least"), F.count(F.lit(1)).alias("_n"))
                    .filter("_n > 1"), "shared")
    in_shared = shared.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    hits = staged(split_join(bands, shared.select("_bucket", "_least"), ["_bucket"],
                             hot_keys(shared, ["_bucket"], "_n", in_shared), F.col("_row")), "hits")
    first = staged(hits.filter("_row != _least").select(F.col("_least").alias("u"), F.col("_row").alias("v"))
                   .distinct(), "pairs")
    involved = hits.select("_row").distinct()
    texts = staged(table.select("_row", "_text", "_sig").join(involved, "_row", "left_semi"), "texts")
    links = staged(verified(first, texts, threshold), "links")
    roots = staged(components(links), "roots")
    more = staged(_links_across(hits, roots, texts, threshold), "more_links")
    if not more.isEmpty():
        roots = staged(components(links.unionByName(more)), "roots")
    placed = rows.join(roots, F.col("_head") == F.col("node"), "left").select(
        "_row", "_doc", F.coalesce("root", "_head").alias("_class"))
    classes = placed.groupBy("_class").agg(F.min(F.struct("_doc", "_row")).alias("_least"),
                                           F.count(F.lit(1)).alias("_size")).filter("_size > 1")
    single = F.struct("_doc", "_row")
    return split_join(placed, classes, ["_class"], hot_keys(classes, ["_class"], "_size", n_rows), F.col("_row"), "left").select(
        "_row", "_doc", F.coalesce("_least", single).alias("_least"), F.coalesce("_size", F.lit(1)).alias("_size"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """One row of ``docs`` of each class, with all its columns. The columns are staged with the signatures
    under the row's id there, so a row is kept or not by itself; a string text is not written twice."""
    plain = dict(docs.dtypes)[text_col] == "string"
    others = [(c, f"_c{k}") for k, c in enumerate(docs.columns) if not (plain and c == text_col)]
    table = staged(signatures(docs, id_col, text_col, F.col(text_col).isNull().alias("_none"),
                              *[F.col(f"`{c}`").alias(inner) for c, inner in others]), "signatures")
    kept = _classed(table, threshold).filter(F.col("_row") == F.col("_least._row")).select("_row")
    inner = dict(others)
    return table.join(kept, "_row", "left_semi").select(
        *[F.col(inner[c]).alias(c) if c in inner else F.when(~F.col("_none"), F.col("_text")).alias(c) for c in docs.columns])
