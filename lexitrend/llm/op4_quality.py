"""Text quality: a regularised quadratic discriminant on document statistics.

Each whole text becomes a vector of statistics (shares of character classes, word lengths,
repetition of words, word pairs and lines, sizes), transformed to be near normal and
standardised. Each class has a mean and a covariance, the latter shrunk towards the pooled
covariance (``alpha``) and towards a multiple of the identity (``gamma``); both amounts are
chosen by cross-validation. The score is the logistic of the calibrated difference of the two
log-densities; their Mahalanobis distances use Cholesky factors computed once per fit. Fitting
uses a bounded sample of labelled rows; scoring is numpy inside the tasks, without a shuffle.

Results that are fixed here:

- null and empty texts have all counts 0 and get the score of such a vector; texts are never cut;
- a repeated row is scored like the first; ids with several labels count by the largest;
- without two labelled rows of both kinds the score is the smoothed share of label 1; with two or more
  the discriminant is fitted, by as many folds as the smaller class allows (four at most);
- a score of exactly 0.5 is predicted 1; columns of the input that clash with names used here are ignored;
- an empty table gives an empty result; label, lang, source and id are no input of a score.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_arrow, mix64, slices, staged, texts_of, word_hashes
from .models import MAX_TRAIN_ROWS, fold, labelled_sample, score_all, sigmoid

HELD_OUT_FOLDS, HELD_OUT = 3, 1
ALPHAS = (0.0, 0.1, 0.3, 0.6, 1.0)
GAMMAS = (0.001, 0.01, 0.1)
CV_FOLDS = 4
CLIP = 6.0
_EPS = 1e-3

# Classes of characters.
OTHER, LOWER, UPPER, DIGIT, SPACE, STOP, COMMA = range(7)


@functools.cache
def char_classes() -> np.ndarray:
    def kind(c: str) -> int:
        if c.isalpha():
            return UPPER if c.isupper() else LOWER
        if c.isdigit():
            return DIGIT
        if c.isspace():
            return SPACE
        return STOP if c in ".!?" else COMMA if c in ",;:'\"()-" else OTHER
    return np.fromiter((kind(chr(c)) for c in range(0x110000)), np.uint8, 0x110000)


def _distinct(doc: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: how many different values it has, and the count of the most frequent one."""
    different, most = np.zeros(n), np.zeros(n)
    if len(value):
        order = np.lexsort((value, doc))
        d, v = doc[order], value[order]
        first = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (v[1:] != v[:-1])])
        size = np.diff(np.r_[first, len(v)])
        different += np.bincount(d[first], minlength=n)
        np.maximum.at(most, d[first], size)
    return different, most


def statistics(texts: list[str]) -> np.ndarray:
    """One row of transformed statistics per text."""
    n = len(texts)
    joined = "".join(texts)
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, n)
    owner = np.repeat(np.arange(n), sizes)
    kinds = np.bincount(owner * 7 + char_classes()[cp], minlength=7 * n).reshape(n, 7).astype(float)
    chars = np.maximum(sizes, 1).astype(float)
    letters = np.maximum(kinds[:, LOWER] + kinds[:, UPPER], 1)
    h, doc = word_hashes(texts)
    words = np.bincount(doc, minlength=n).astype(float)
    some = np.maximum(words, 1)
    distinct, most = _distinct(doc, h, n)
    pair_doc = doc[1:][doc[1:] == doc[:-1]]
    same = doc[1:] == doc[:-1]
    pairs = (mix64(h[:-1]) * np.uint64(3) + h[1:])[same]
    twice = np.bincount(pair_doc[(h[1:] == h[:-1])[same]], minlength=n)
    distinct_pairs, _ = _distinct(pair_doc, pairs, n)
    n_pairs = np.maximum(words - 1, 1)
    lines = [t.split("\n") for t in texts]
    n_lines = np.fromiter(map(len, lines), float, n)
    unlike = np.fromiter((len(set(x)) for x in lines), float, n)
    doubled = np.bincount(owner[1:][(cp[1:] == cp[:-1]) & (owner[1:] == owner[:-1])], minlength=n)

    def share(x, of):
        return np.log(x / of + _EPS)

    return np.stack([
        np.log1p(sizes), np.log1p(words), np.log1p(letters / some), share(kinds[:, UPPER], letters),
        share(kinds[:, OTHER], chars), share(kinds[:, DIGIT], chars), share(kinds[:, SPACE], chars),
        share(kinds[:, STOP], chars), share(kinds[:, COMMA], chars),
        np.log(distinct + 1) / np.log(words + 2), share(most, some), share(twice, n_pairs),
        share(n_pairs - np.minimum(distinct_pairs, n_pairs), n_pairs), np.log1p(n_lines),
        share(n_lines - unlike, n_lines), np.log1p(chars / n_lines), share(doubled, chars)], axis=1)


@dataclass
class Gaussian:
    """A class density with its Cholesky factor."""

    mean: np.ndarray
    factor: np.ndarray
    log_det: float

    @classmethod
    def of(cls, mean: np.ndarray, covariance: np.ndarray) -> Gaussian:
        factor = np.linalg.cholesky(covariance)
        return cls(mean, np.linalg.inv(factor), 2 * float(np.log(factor.diagonal()).sum()))

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = np.einsum("ij,nj->ni", self.factor, x - self.mean)   # the inverse factor, cached
        return -0.5 * ((z * z).sum(1) + self.log_det)


def fit_pair(x: np.ndarray, y: np.ndarray, alpha: float, gamma: float) -> tuple[Gaussian, Gaussian]:
    """Both class densities with shrunken covariances."""
    d = x.shape[1]
    means = [x[y == k].mean(0) for k in (0, 1)]
    own = [np.einsum("ni,nj->ij", x[y == k] - means[k], x[y == k] - means[k]) for k in (0, 1)]
    pooled = (own[0] + own[1]) / len(y)
    out = []
    for k in (0, 1):
        cov = (1 - alpha) * own[k] / max(1, (y == k).sum()) + alpha * pooled
        cov = (1 - gamma) * cov + gamma * max(1e-6, np.trace(cov) / d) * np.eye(d)
        out.append(Gaussian.of(means[k], cov + 1e-9 * np.eye(d)))
    return out[0], out[1]


def towards_pooled(alpha: float, y: np.ndarray, d: int) -> float:
    """``alpha`` raised as far as the smaller class has few rows for its ``d`` dimensions: its own
    covariance counts n / (n + d) of what it would."""
    few = min(int((y == k).sum()) for k in (0, 1))
    return 1 - (1 - alpha) * few / (few + d)


def calibrate(s: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic fit of ``y`` on ``s`` (Newton steps, lightly damped)."""
    scale = max(1e-9, s.std())
    x = np.stack([s / scale, np.ones_like(s)], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(x @ w)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - y) + 1e-3 * w)
        w -= step * min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0] / scale), float(w[1])


@dataclass
class Model:
    shift: np.ndarray
    scale: np.ndarray
    low: Gaussian | None
    high: Gaussian | None
    slope: float
    bias: float

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.shift) / self.scale, -CLIP, CLIP)

    def __call__(self, texts: list[str]) -> np.ndarray:
        if self.low is None:
            return np.full(len(texts), sigmoid(np.array(self.bias)))
        x = self.standard(statistics(texts))
        return sigmoid(self.slope * (self.high.log_density(x) - self.low.log_density(x)) + self.bias)


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """The model of a sample's statistics ``x`` and labels ``y``."""
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())
    if min(n1, n0) < 2:
        return Model(np.zeros(1), np.ones(1), None, None, 0.0, float(np.log((n1 + 1) / (n0 + 1))))
    shift, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.clip((x - shift) / scale, -CLIP, CLIP)
    # Rows are dealt to folds within each class, so every fold leaves rows of both to learn from.
    part, folds = np.zeros(len(y), np.int64), min(CV_FOLDS, n1, n0)
    for k in (0, 1):
        part[y == k] = np.arange((y == k).sum()) % folds
    best = None
    for alpha in ALPHAS:
        for gamma in GAMMAS:
            s = np.zeros(len(y))
            for k in range(folds):
                own = y[part != k]
                low, high = fit_pair(z[part != k], own, towards_pooled(alpha, own, z.shape[1]), gamma)
                s[part == k] = high.log_density(z[part == k]) - low.log_density(z[part == k])
            slope, bias = calibrate(s, y)
            p = np.clip(sigmoid(slope * s + bias), 1e-9, 1 - 1e-9)
            loss = -float(np.where(y == 1, np.log(p), np.log(1 - p)).mean())
            if np.isfinite([loss, slope, bias]).all() and (best is None or loss < best[0] - 1e-9):
                best = (loss, alpha, gamma, slope, bias)
    _, alpha, gamma, slope, bias = best
    low, high = fit_pair(z, y, towards_pooled(alpha, y, z.shape[1]), gamma)
    return Model(shift, scale, low, high, slope, bias)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          folds: int = HELD_OUT_FOLDS, held_out: int = HELD_OUT, max_rows: int = MAX_TRAIN_ROWS) -> Model:
    """The model fitted on at most ``max_rows`` labelled rows outside the held-out fold."""
    sample = staged(labelled_sample(docs, labels, "quality", fold(id_col, folds) != held_out, id_col,
                                    text_col, max_rows), "quality_sample")

    def run(batches):
        for batch in batches:
            for lo, hi in slices(batch.column(2)):
                x = statistics(texts_of(batch.column(2), lo, hi))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo).cast(pa.string()), batch.column(1).slice(lo, hi - lo),
                     pa.array(x.tolist(), pa.list_(pa.float64()))], names=["id", "label", "x"])

    rows = sorted(map_arrow(sample, run, "id string, label int, x array<double>").collect(),
                  key=lambda r: r["id"])  # at most max_rows short vectors
    x = np.array([r["x"] for r in rows], float).reshape(len(rows), -1 if rows else 1)
    return fit(x, np.array([int(r["label"] == 1) for r in rows], np.int64))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          folds: int = HELD_OUT_FOLDS, held_out: int = HELD_OUT, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted``; rows of the held-out fold are never learnt from."""
    model = train(docs, labels, id_col, text_col, folds, held_out, max_rows)
    return score_all(docs, model, fold(id_col, folds) == held_out, id_col, text_col)
