"""Classifiers at every order and number of labels: finite scores, and both classes learnt."""

import numpy as np
import pytest

from lexitrend.llm import op2_toxicity as toxicity
from lexitrend.llm import op4_quality as quality
from tests.llm import edge


def sample(n, every, seed=0):
    rng = np.random.default_rng(seed)
    y = (np.arange(n) % every == 0).astype(np.int64)
    return rng.normal(size=(n, 17)) + 1.5 * y[:, None], y


@pytest.mark.parametrize("every", range(2, 9))
def test_quality_with_the_label_at_every_kth_id(every):
    x, y = sample(80, every)
    model = quality.fit(x, y)
    assert np.isfinite([model.slope, model.bias]).all() and model.slope > 0
    s = model.slope * (model.high.log_density(model.standard(x)) - model.low.log_density(model.standard(x))) + model.bias
    assert np.isfinite(s).all() and s[y == 1].mean() > s[y == 0].mean()


@pytest.mark.parametrize("few", [2, 3, 7, 8])
@pytest.mark.parametrize("which", [0, 1])
def test_quality_with_few_rows_of_a_class(few, which):
    x, y = sample(60, 2)
    at = np.r_[np.flatnonzero(y == which)[:few], np.flatnonzero(y != which)]
    x, y = x[at], y[at]
    model = quality.fit(x, y)
    assert model.low is not None
    z = model.standard(x)
    p = quality.sigmoid(model.slope * (model.high.log_density(z) - model.low.log_density(z)) + model.bias)
    assert np.isfinite(p).all() and ((0 <= p) & (p <= 1)).all() and len(set(p.round(6))) > 1
    assert p[y == 1].mean() > p[y == 0].mean()


def test_one_row_of_a_class_gives_the_smoothed_share():
    x, y = sample(20, 20)
    assert quality.fit(x, y)(["a", "b"]) == pytest.approx([2 / 22] * 2)


@pytest.mark.parametrize("n", [4, 14, 16, 40])
def test_toxicity_learns_from_few_rows(spark, n):
    rows = [(i, f"you are idiot scum, number {i}" if i % 2 else f"a kind and calm word, number {i}") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(n)], "doc_id long, quality int, toxic int")
    bad, good = toxicity.train(docs, labels)(["idiot scum", "kind calm"])
    assert bad > 0.5 > good


def test_toxicity_fit_is_the_optimum(spark):
    """The penalised loss at the fitted weights: its gradient, by differences, is zero."""
    rng = np.random.default_rng(1)
    words = ["idiot", "scum", "kind", "calm", "women", "muslims", "town", "river"]
    rows = [(i, " ".join(rng.choice(words, 4))) for i in range(60)]
    lab = [(i, 1, int(("idiot" in t) + ("scum" in t) + rng.random() > 1)) for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(lab, "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels, folds=1 << 30)
    texts, y = [t for _, t in rows], np.array([x[2] for x in lab])
    index = {t: int(np.searchsorted(model.hashes, h)) for t, h in zip(
        toxicity.IDENTITY_TERMS, toxicity.hash_of(toxicity.IDENTITY_TERMS))}
    pairs = [(index[a], index[b]) for t in texts for (a, b), n in toxicity.swaps(t).items() for _ in range(n)]

    def loss(w, bias):
        doc, k = toxicity.presence(texts, model.hashes)
        s = np.full(len(texts), bias)
        np.add.at(s, doc, w[k])
        fit = np.logaddexp(0, s).sum() - (s * y).sum()
        swap = sum((w[a] - w[b]) ** 2 for a, b in pairs)
        return fit + toxicity.COUNTERFACTUAL * swap / 2 + toxicity.L2 * (w ** 2).sum() / 2

    best = loss(model.weights, model.bias)
    for _ in range(30):
        step = rng.normal(size=len(model.weights)) * 1e-2
        assert loss(model.weights + step, model.bias + rng.normal() * 1e-2) >= best - 1e-6


def test_ties_at_one_half_are_predicted(spark):
    docs = edge.documents(spark)
    none = edge.empty(spark, "doc_id long, quality int, toxic int")
    assert {(r["score"], r["predicted"]) for op in (toxicity, quality) for r in op.score(docs, none).collect()} == {(0.5, 1)}
