"""Toxicity: a counterfactual-regularised word classifier.

A logistic model over the presence of words. Words are chosen by how strongly they go with the
label (likelihood ratio) in a bounded sample of labelled rows; identity terms are always among
the words. For each labelled sentence that mentions an identity term, the term is swapped for
every other term of its group and for a neutral word; the difference of the two log-odds,
squared, is added to the loss (counterfactual logit pairing). As the model is linear in word
presence, that difference is the difference of two weights, so the sentences enter as counts per
pair of terms. Mentioning a group then moves the score no more than the neutral word does. The
model is fitted by Newton steps on the driver (its size is the number of words, a parameter) and
every whole text is scored in numpy inside the tasks; no text is shuffled.

Results that are fixed here:

- null and empty texts get the score of a text without words; texts are never cut;
- a repeated row is scored like the first; ids with several labels count by the largest;
- without labelled rows of both kinds the score is the smoothed share of label 1 (0.5 if none);
- an empty table gives an empty result; label, lang, source and id are no input of a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, slices, staged, texts_of, trim, word_hashes
from .models import MAX_TRAIN_ROWS, fold, labelled_sample, score_all, score_column, sigmoid

#: Words of the model: those most tied to the label. Weak ones are left to the penalty, so the rule is
#: the same for few labelled rows and for many.
MAX_WORDS = 1024
L2 = 0.2
COUNTERFACTUAL = 1.0
HELD_OUT_FOLDS = 5
#: Rows of the sample whose part of the normal equations is summed at once.
FIT_ROWS = 1000

# --- fixed values: identity terms by group; the first of each group is the neutral word --------
IDENTITY_GROUPS = (
    ("people", "women", "men", "girls", "boys", "transgender", "trans", "woman", "man", "female", "male"),
    ("people", "christians", "muslims", "jews", "hindus", "buddhists", "atheists", "christian", "muslim",
     "jewish", "catholic", "catholics", "islam", "islamic"),
    ("people", "black", "white", "asian", "latino", "hispanic", "arab", "african", "european", "native",
     "blacks", "whites", "asians"),
    ("people", "gay", "lesbian", "straight", "bisexual", "queer", "homosexual", "heterosexual"),
    ("people", "immigrants", "refugees", "foreigners", "citizens", "migrants"),
    ("people", "disabled", "deaf", "blind", "old", "young", "elderly", "poor", "rich"),
    ("menschen", "frauen", "männer", "muslime", "christen", "juden", "schwule", "lesben", "ausländer",
     "flüchtlinge", "schwarze", "weiße"),
    ("gens", "femmes", "hommes", "musulmans", "chrétiens", "juifs", "homosexuels", "lesbiennes",
     "immigrés", "étrangers", "noirs", "blancs"),
    ("gente", "mujeres", "hombres", "musulmanes", "cristianos", "judíos", "homosexuales", "lesbianas",
     "inmigrantes", "extranjeros", "negros", "blancos"),
)
IDENTITY_TERMS = tuple(dict.fromkeys(t for g in IDENTITY_GROUPS for t in g))
_SENTENCE = re.compile(r"[.!?\n]+")
_TERM = re.compile(r"\b(?:" + "|".join(sorted(map(re.escape, IDENTITY_TERMS), key=len, reverse=True)) + r")\b")


def hash_of(words: tuple[str, ...]) -> np.ndarray:
    return word_hashes(list(words))[0]


def swaps(text: str) -> dict[tuple[str, str], int]:
    """Counterfactual sentences of a text: for (term, other) how many sentences mention the term
    and not the other, so that swapping gives a new sentence."""
    out: dict[tuple[str, str], int] = {}
    lowered = text.lower()
    if not _TERM.search(lowered):
        return out
    for sentence in _SENTENCE.split(lowered):
        present = set(_TERM.findall(sentence))
        for group in IDENTITY_GROUPS if present else ():
            for a in present.intersection(group):
                for b in group:
                    if b not in present:
                        out[a, b] = out.get((a, b), 0) + 1
    return out


def tied_words(sample: DataFrame) -> tuple[int, int, np.ndarray]:
    """How many sample texts have label 1 and another, and the hashes of the words most tied to
    the label. Counting and ranking run in Spark; at most ``MAX_WORDS`` rows come to the driver."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, texts = (batch.column(j) for j in range(3))
            for lo, hi in slices(texts):
                h, doc = word_hashes(texts_of(texts, lo, hi))
                pair = np.unique(np.stack((doc.astype(np.uint64), h)), axis=1) if len(h) else np.empty((2, 0), np.uint64)
                at = pa.array(pair[0].astype(np.int64) + lo)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(at), labels.take(at), pa.array(pair[1].view(np.int64))], names=["_id", "_label", "_word"])

    schema = f"_id {dict(sample.dtypes)['_id']}, _label int, _word long"
    per_text = map_arrow(sample, words, schema)
    totals = sample.groupBy("_label").count().collect()
    n = {r["_label"]: r["count"] for r in totals}
    n1, n0 = n.get(1, 0), sum(c for k, c in n.items() if k != 1)
    counts = per_text.groupBy("_word").agg(F.sum(F.expr("int(_label = 1)")).alias("a"),
                                           F.sum(F.expr("int(_label != 1)")).alias("b"))
    a, b, c, d = F.col("a"), F.col("b"), F.lit(n1) - F.col("a"), F.lit(n0) - F.col("b")
    total = float(max(1, n1 + n0))

    def part(x, row, col):
        return F.when(x > 0, x * F.log(x * total / (row * col))).otherwise(0.0)

    tie = 2 * (part(a, a + b, F.lit(n1)) + part(b, a + b, F.lit(n0)) + part(c, c + d, F.lit(n1))
               + part(d, c + d, F.lit(n0)))
    chosen = [r["_word"] for r in counts.withColumn("tie", tie).orderBy(F.desc("tie"), "_word").limit(MAX_WORDS).collect()]
    return n1, n0, np.array(chosen, np.int64).view(np.uint64)


@dataclass
class Model:
    """Sorted word hashes with their weights, and the intercept."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float

    def __call__(self, texts: list[str]) -> np.ndarray:
        total = np.full(len(texts), self.bias)
        doc, k = presence(texts, self.hashes)
        np.add.at(total, doc, self.weights[k])
        return sigmoid(total)


def presence(texts: list[str], hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(text, word)`` of the words of a sorted hash list that each text holds, once each."""
    h, doc = word_hashes(texts)
    if not len(h) or not len(hashes):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    maybe = np.zeros(1 << 16, bool)
    maybe[(hashes >> np.uint64(48)).astype(np.int64)] = True
    keep = maybe[(h >> np.uint64(48)).astype(np.int64)]
    h, doc = h[keep], doc[keep]
    k = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
    hit = hashes[k] == h
    pair = np.unique(doc[hit] * np.int64(len(hashes)) + k[hit])
    return pair // len(hashes), pair % len(hashes)


def fit(sample: DataFrame) -> Model:
    """The model of a bounded labelled sample (columns ``_id, _label, _text``)."""
    n1, n0, chosen = tied_words(sample)
    if not n1 or not n0:
        return Model(np.empty(0, np.uint64), np.empty(0), float(np.log((n1 + 1) / (n0 + 1))))
    hashes = np.unique(np.concatenate((chosen, hash_of(IDENTITY_TERMS))))
    index = {t: int(np.searchsorted(hashes, h)) for t, h in zip(IDENTITY_TERMS, hash_of(IDENTITY_TERMS))}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, texts = batch.column(1), batch.column(2)
            for lo, hi in slices(texts):
                held = texts_of(texts, lo, hi)
                doc, k = presence(held, hashes)
                words = np.split(k.astype("<i2"), np.searchsorted(doc, np.arange(1, hi - lo)))
                found = [np.array([index[x] * len(hashes) + index[y] for (x, y), n in swaps(t).items() for _ in range(n)], "<i8")
                         for t in held]
                yield pa.RecordBatch.from_arrays(
                    [labels.slice(lo, hi - lo), pa.array([w.tobytes() for w in words], pa.binary()),
                     pa.array([f.tobytes() for f in found], pa.binary())], names=["label", "words", "swaps"])

    # The rows stay packed, and the matrix is a byte an entry, taken ``FIT_ROWS`` rows at a time.
    rows = map_arrow(sample, vectors, "label int, words binary, swaps binary").collect()
    y = np.array([r["label"] == 1 for r in rows], float)
    held = np.zeros((len(rows), len(hashes) + 1), np.uint8)
    held[:, -1] = 1
    penalty = np.zeros((len(hashes) + 1, len(hashes) + 1))
    for i, r in enumerate(rows):
        held[i, np.frombuffer(r["words"], "<i2")] = 1
        for s in np.frombuffer(r["swaps"], "<i8").tolist():
            p, q = divmod(s, len(hashes))
            penalty[p, p] += 1
            penalty[q, q] += 1
            penalty[p, q] -= 1
            penalty[q, p] -= 1
    del rows
    penalty = COUNTERFACTUAL * penalty + L2 * np.diag(np.r_[np.ones(len(hashes)), 1e-6])
    w = np.zeros(held.shape[1])
    for _ in range(25):
        gradient, hessian = penalty @ w, penalty.copy()
        for lo in range(0, len(held), FIT_ROWS):
            x = held[lo: lo + FIT_ROWS].astype(np.float32)
            p = sigmoid(x @ w.astype(np.float32)).astype(float)
            gradient += (p - y[lo: lo + FIT_ROWS]) @ x
            hessian += (x * (p * (1 - p)).astype(np.float32)[:, None]).T @ x
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    del held, hessian
    trim()      # the driver's process lives on beside its JVM
    return Model(hashes, w[:-1], float(w[-1]))


def train(docs: DataFrame, labels: DataFrame, folds: int = HELD_OUT_FOLDS, id_col: str = "doc_id",
          text_col: str = "text", max_rows: int = MAX_TRAIN_ROWS) -> Model:
    """The model fitted on at most ``max_rows`` labelled rows outside fold 0."""
    return fit(staged(labelled_sample(docs, labels, "toxic", fold(id_col, folds) != 0, id_col, text_col,
                                      max_rows), "toxicity_sample"))


def score(docs: DataFrame, labels: DataFrame, folds: int = HELD_OUT_FOLDS, id_col: str = "doc_id",
          text_col: str = "text", max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted``; rows of fold 0 are never learnt from."""
    model = train(docs, labels, folds, id_col, text_col, max_rows)
    return score_all(docs, model, fold(id_col, folds) == 0, id_col, text_col)


def keep_clean(docs: DataFrame, labels: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns; no shuffle."""
    model = train(docs, labels, text_col=text_col, **options)
    return docs.filter(score_column(F.col(text_col).cast("string"), model, docs.sparkSession) < 0.5)
