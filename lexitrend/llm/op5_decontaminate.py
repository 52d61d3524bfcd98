"""Benchmark decontamination by pigeonhole edit matching.

Texts are normalised to lower-case words with one space between. A test item of ``n`` characters
may differ from a passage of a document in ``k = n * ERROR_RATE`` characters. It is split into
``k + 1`` pieces: ``k`` edits cannot touch all of them, so a passage within the budget holds one
piece exactly, about where the piece stands in the item. All pieces of a block of items are
found in one pass over each whole text (Aho-Corasick); each place found is verified by Myers'
bit-parallel edit distance of the whole item against the passage. Nothing is shuffled: a task
holds the documents of its partition and one block of items, whose size is bounded; a Python worker
keeps the automaton of its last block from batch to batch and from task to task.

Results that are fixed here:

- one row per document and item found, with the smallest distance of all its places; a document
  row that is repeated is reported as often as it occurs;
- null and empty texts and items without words match nothing; items shorter than ``1 / ERROR_RATE``
  characters must occur exactly;
- equal items are each reported; items are compared as characters. With ``word_edges`` an item that
  must occur exactly counts only where it begins and ends at the edge of a word (so ``ai`` is not found
  in ``train``); edges are those of digits and of letters with two cases, as other scripts may write
  words without spaces. The query and the pipeline ask for word edges;
- empty tables give an empty result; further columns are ignored.
"""

from __future__ import annotations

import functools
import pickle
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import map_arrow, ship, slices, texts_of

ERROR_RATE = 0.08
#: Characters of items that one pass over the documents looks for; more items take more passes.
BLOCK_CHARS = 1_000_000
_GAP = re.compile(r"[\W_]+")


def normalise(text: str | None) -> str:
    return _GAP.sub(" ", (text or "").lower()).strip()


def split_pieces(item: str, parts: int) -> list[tuple[int, str]]:
    """``parts`` pieces of nearly equal length with their offsets."""
    n = len(item)
    cuts = [n * i // parts for i in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """The least edit distance of ``pattern`` to any part of ``text``, and where that part ends
    (Myers 1999; one arbitrary-length integer holds a column of the dynamic programme)."""
    m = len(pattern)
    if m == 0:
        return 0, 0
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    mask, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = mask, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & mask
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & mask
        pv = (mh << 1 & mask) | ~(xv | ph) & mask
        mv = ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


def _runs_on(a: str, b: str) -> bool:
    """Whether two neighbouring characters belong to one word (of a script that puts spaces)."""
    return all(c.isdigit() or c.lower() != c.upper() for c in (a, b))


class Matcher:
    """A block of items, ready to be looked for in texts."""

    def __init__(self, items: list[tuple[object, str]], error_rate: float, word_edges: bool = False):
        import ahocorasick

        self.items = [(key, text, int(len(text) * error_rate)) for key, text in items]
        places: dict[str, list[tuple[int, int]]] = {}
        for i, (_, text, k) in enumerate(self.items):
            for offset, piece in split_pieces(text, k + 1):
                places.setdefault(piece, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()
        self.empty = not places
        self.word_edges = word_edges

    def _cut(self, text: str, a: int, b: int) -> bool:
        """Whether ``text[a:b]`` begins or ends inside a word."""
        return a > 0 and _runs_on(text[a - 1], text[a]) or b < len(text) and _runs_on(text[b - 1], text[b])

    def find(self, text: str) -> list[tuple[object, int, int, int]]:
        """``(item key, distance, end in the normalised text, item characters)`` within budget."""
        if self.empty or not text:
            return []
        starts: dict[int, list[int]] = {}
        for last, (size, where) in self.automaton.iter(text):
            for i, offset in where:
                if self.word_edges and not self.items[i][2] and self._cut(text, last + 1 - size, last + 1):
                    continue
                starts.setdefault(i, []).append(last + 1 - size - offset)
        found = []
        for i, at in starts.items():
            key, item, k = self.items[i]
            best = None
            at.sort()
            lo = 0
            for hi in range(1, len(at) + 1):   # places whose passages overlap are verified at once
                if hi < len(at) and at[hi] - at[hi - 1] <= 2 * k:
                    continue
                a = max(0, at[lo] - k)
                d, end = myers(item, text[a: at[hi - 1] + len(item) + k])
                if d <= k and (best is None or d < best[0]):
                    best = (d, a + end)
                lo = hi
            if best:
                found.append((key, *best, len(item)))
        return found


@functools.lru_cache(maxsize=1)
def matcher_of(block: bytes, error_rate: float, word_edges: bool) -> Matcher:
    """The matcher of a pickled block, kept by a Python worker from batch to batch."""
    return Matcher(pickle.loads(block), error_rate, word_edges)


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[bytes]:
    """The normalised items in pickled blocks of about ``block_chars`` characters, one at a time."""
    rows = items.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).filter(
        F.col("_text").isNotNull())
    total = rows.agg(F.sum(F.length("_text"))).first()[0] or 0
    parts = max(1, -(-total // block_chars))
    for part in range(parts):
        block = rows.filter(F.pmod(F.xxhash64("_id", "_text"), F.lit(parts)) == part).collect()
        yield pickle.dumps([(r["_id"], t) for r in block if (t := normalise(r["_text"]))])


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_id_col: str = "item_id", item_text_col: str = "text",
            error_rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS, word_edges: bool = False) -> DataFrame:
    """``doc_id, item_id, distance, match_end, item_chars`` for each item found in a document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kinds = (dict(rows.dtypes)["doc_id"], dict(items.dtypes)[item_id_col])
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, distance int, match_end long, item_chars int"

    item_type = to_arrow_type(items.schema[item_id_col].dataType)

    def searcher(block: bytes):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = matcher_of(block, error_rate, word_edges)
            for batch in batches:
                ids, texts = batch.column(0), batch.column(1)
                for lo, hi in slices(texts):
                    found = [(lo + k, *m) for k, t in enumerate(texts_of(texts, lo, hi))
                             for m in matcher.find(normalise(t))]
                    if found:
                        at, item, dist, end, size = zip(*found)
                        yield pa.RecordBatch.from_arrays(
                            [ids.take(pa.array(at, pa.int64())), pa.array(item, item_type), pa.array(dist, pa.int32()),
                             pa.array(end, pa.int64()), pa.array(size, pa.int32())],
                            names=["doc_id", "item_id", "distance", "match_end", "item_chars"])
        return run

    result = None
    for block in item_blocks(items, item_id_col, item_text_col, block_chars):
        part = map_arrow(rows, searcher(block), schema)
        result = part if result is None else result.unionAll(part)
    return result


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                      item_text_col: str = "text", error_rate: float = ERROR_RATE,
                      block_chars: int = BLOCK_CHARS, word_edges: bool = False) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns; no shuffle."""
    ship(docs.sparkSession)

    def holds(block: bytes):
        @F.arrow_udf("boolean")
        def run(texts: pa.Array) -> pa.Array:
            matcher = matcher_of(block, error_rate, word_edges)
            return pa.array([bool(matcher.find(normalise(t))) for lo, hi in slices(texts)
                             for t in texts_of(texts, lo, hi)], pa.bool_())
        return run(F.col(text_col).cast("string"))

    for block in item_blocks(items, item_id_col, item_text_col, block_chars):
        docs = docs.filter(~holds(block))
    return docs
