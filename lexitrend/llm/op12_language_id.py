"""Language identification by compression with per-language dictionaries.

Each learned language has a zstandard raw-content dictionary: pieces of its labelled texts, letters
only and in lower case. A text is normalised the same way, cut into blocks and every block is
compressed with every language's dictionary; the language whose compressed blocks are smallest in
sum is chosen. Each block begins with the same run of blanks, so that the encoder's rule against
small gains does not store short texts unencoded. A choice is ``accepted`` only when the next
language's size is clearly larger; otherwise the margin is too narrow to rely on and ``identify``
with ``reject=True`` gives no language.

The dictionaries come from a bounded sample: ``MAX_LANG_ROWS`` labelled documents of a language
(chosen by a hash of the id), and of their pieces the ``DICT_PIECES`` with the smallest hashes, which
is about 128 KB a language; that much per language reaches the driver and the tasks. Scoring
needs no shuffle and reads whole texts.

Results that are fixed here:

- a null text, and a text without a letter, is ``und`` with score 0 and not accepted;
- equal sizes: the language with more labelled documents, then the smaller name;
- without any learned language every row is ``und``; rows with a null id are not learnt from;
- repeated rows are scored alike; further columns of the input do not matter; no rows, no result.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, ship, slices, staged, texts_of
from .models import fold

HELD_OUT_FOLDS, HELD_OUT = 5, 0
UNKNOWN = "und"
#: Labelled documents of a language that its dictionary is taken from, at most.
MAX_LANG_ROWS = 400
#: Pieces of a dictionary, and characters of a piece.
DICT_PIECES, PIECE_CHARS = 256, 512
#: Salts of the first of the two rankings by which the documents are chosen.
SALTS = 64
LEVEL, MIN_MATCH = 5, 3
BLOCK_BYTES = 8192
LEAD = b" " * 128
#: Bytes by which sizes must differ for odds of e to 1.
ODDS_BYTES = 4.0
#: The next language's size must exceed the best by this share (and by one byte) to be accepted.
NARROW = 0.01


def letters(text: Column) -> Column:
    """Lower-case letters and marks, words parted by one blank; null stays null."""
    return F.trim(F.regexp_replace(F.lower(text.cast("string")), r"[^\p{L}\p{M}]+", " "))


@dataclass(frozen=True)
class Model:
    """Dictionaries by language, in the order in which equal sizes are decided."""

    languages: tuple[str, ...]
    dictionaries: tuple[bytes, ...]

    def sizes(self, text: str) -> list[int]:
        """Compressed bytes of a normalised text per language."""
        raw = text.encode("utf-8", "surrogatepass")
        blocks = [LEAD + raw[i:i + BLOCK_BYTES] for i in range(0, len(raw), BLOCK_BYTES)]
        return [sum(len(c.compress(b)) for b in blocks) for c in compressors(self.dictionaries)]

    def decide(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether the margin suffices, of a normalised text."""
        if not text or not self.languages:
            return UNKNOWN, 0.0, False
        size = self.sizes(text)
        best = min(range(len(size)), key=size.__getitem__)
        score = 1.0 / sum(math.exp(-(s - size[best]) / ODDS_BYTES) for s in size)
        rest = [s for k, s in enumerate(size) if k != best]
        return self.languages[best], score, not rest or min(rest) - size[best] >= max(1.0, NARROW * size[best])


@functools.lru_cache(maxsize=4)
def compressors(dictionaries: tuple[bytes, ...]) -> list[zstandard.ZstdCompressor]:
    """One compressor per dictionary, prepared once per worker."""
    out = []
    for raw in dictionaries:
        params = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, source_size=BLOCK_BYTES, dict_size=len(raw), min_match=MIN_MATCH, write_content_size=False,
            write_checksum=False, write_dict_id=False)
        content = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(compression_params=params)
        out.append(zstandard.ZstdCompressor(dict_data=content, compression_params=params))
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          folds: int = HELD_OUT_FOLDS, held_out: int = HELD_OUT, max_rows: int = MAX_LANG_ROWS,
          max_pieces: int = DICT_PIECES) -> Model:
    """The dictionaries of all languages that have a labelled document outside the held-out fold."""
    rows = docs.filter(fold(id_col, folds) != held_out).select(
        F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("_lang"),
        F.col(text_col).cast("string").alias("_text")).filter("_id is not null and _lang is not null and _text is not null")
    # The counts and the choice move ids only; the texts of the chosen ids (bounded) are read after it.
    # The smallest hashes are taken within salts first, so no task meets a whole language.
    order = (F.xxhash64("_id"), F.col("_id"))
    salted = Window.partitionBy("_lang", "_salt").orderBy(*order)
    some = rows.select("_id", "_lang", F.pmod(F.xxhash64("_id", F.lit("salt")), F.lit(SALTS)).alias("_salt")).withColumn(
        "_k", F.row_number().over(salted)).filter(F.col("_k") <= max_rows)
    chosen = staged(some.withColumn("_k", F.row_number().over(Window.partitionBy("_lang").orderBy(*order)))
                    .filter(F.col("_k") <= max_rows).select(F.col("_id").alias("_i"), F.col("_lang").alias("_l"))
                    .distinct(), "language_ids")
    counts = {r["_lang"]: r["n"] for r in rows.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    sample = rows.join(F.broadcast(chosen), (F.col("_id") == F.col("_i")) & (F.col("_lang") == F.col("_l")), "left_semi")

    def cut(batches):
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                texts = texts_of(batch.column(1), lo, hi)
                langs = batch.column(0).slice(lo, hi - lo).to_pylist()
                both = [(g, t[i:i + PIECE_CHARS]) for g, t in zip(langs, texts) for i in range(0, len(t), PIECE_CHARS)]
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in both], pa.string()) for k in (0, 1)],
                                                 names=["_lang", "piece"])

    pieces = map_arrow(sample.select("_lang", letters(F.col("_text")).alias("_t")), cut, "_lang string, piece string")
    ranked = Window.partitionBy("_lang").orderBy("_h", "piece")
    kept = pieces.filter("piece != ''").distinct().withColumn("_h", F.xxhash64("piece")).withColumn(
        "_k", F.row_number().over(ranked)).filter(F.col("_k") <= max_pieces).collect()
    found: dict[str, list] = {}
    for r in sorted(kept, key=lambda r: (r["_lang"], r["_k"])):
        found.setdefault(r["_lang"], []).append(r["piece"])
    order = sorted(found, key=lambda g: (-counts[g], g))
    return Model(tuple(order), tuple(" ".join(found[g]).encode("utf-8", "surrogatepass") for g in order))


def identify(docs: DataFrame, model: Model, text_col: str = "text", reject: bool = False) -> DataFrame:
    """``docs`` plus ``lang_pred, score, accepted`` (replacing columns of these names); with
    ``reject`` a narrow margin gives ``und``."""
    ship(docs.sparkSession)

    @F.arrow_udf("struct<lang_pred: string, score: double, accepted: boolean>")
    def decide(texts: pa.Array) -> pa.Array:
        out = [model.decide(t) for lo, hi in slices(texts) for t in texts_of(texts, lo, hi)]
        if reject:
            out = [x if x[2] else (UNKNOWN, x[1], False) for x in out]
        return pa.StructArray.from_arrays(
            [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64()),
             pa.array([x[2] for x in out], pa.bool_())], names=["lang_pred", "score", "accepted"])

    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "accepted")]
    found = docs.select(*kept, F.struct(decide(letters(F.col(text_col)))).getField("col1").alias("_found"))
    return found.select(*kept, "_found.lang_pred", "_found.score", "_found.accepted")


def predict(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            folds: int = HELD_OUT_FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, accepted`` for every row; rows of the held-out fold are
    never learnt from, and a prediction depends on the text alone."""
    model = train(docs, id_col, text_col, lang_col, folds, held_out)
    rows = docs.select(F.col(id_col).alias("doc_id"), (fold(id_col, folds) == held_out).alias("held_out"),
                       F.col(text_col).alias("_text"))
    return identify(rows, model, "_text").drop("_text")
