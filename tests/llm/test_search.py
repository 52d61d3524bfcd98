import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from lexitrend.llm import catalog
from lexitrend.llm import op13_lexical_search as lexical
from tests.llm import edge

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in TERM.findall(text or "")]


def brute(docs, items, k=10):
    own = [(i, Counter(words(t))) for i, t in docs]
    own = [(i, c, sum(c.values())) for i, c in own if c]
    n_docs, n_terms = len(own), sum(x[2] for x in own)
    df = Counter(w for _, c, _ in own for w in c)
    weight = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for w, d in df.items()}
    out = []
    for item, text in items:
        scored = []
        for i, c, n in own:
            m = 100 - 75 + 75 * n * n_docs // n_terms
            s = sum(weight[w] * (1_000_000_000 * c[w] // (1000 * c[w] + 8 * m)) for w in words(text) if w in c)
            if s > 0:
                scored.append((-s, i is None, i if i is not None else 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def got(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=str)


def random_tables(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Über", "naïve", "Straße"]
    text = lambda n: " ".join(vocabulary[int(rng.random() ** 3 * len(vocabulary))] for _ in range(n))
    docs = [(i, text(rng.randint(1, 60))) for i in range(700)]
    copy = text(40)
    docs += [(1000 + i, copy) for i in range(150)] + [(2000, None), (2001, ""), (2002, "--"), (None, text(9)), (5, text(12))]
    items = [(i, text(rng.randint(1, 25))) for i in range(20)] + [(50, copy), (51, ""), (52, None), (53, "unheard"), (3, "w1 w1 w2")]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    docs, items = random_tables(seed)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    q = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert got(lexical.search_all(d, q)) == want
    assert got(lexical.search_all(d, q, block_items=7)) == want


def tree(rng, n=300, size=40):
    rows = [(i, int(t), int(v)) for i in range(n) for t, v in zip(rng.choice(size, 6, replace=False),
                                                                 rng.integers(1, 10 ** 10, 6))]
    o, t, v = (np.array(x) for x in zip(*rows))
    return lexical.Tree.of(list(range(n)), o, t, v, size), o, t, v


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(0)
    it, o, t, v = tree(rng)
    dense = np.zeros((300, 40), np.int64)
    dense[o, t] = v
    for _ in range(50):
        number = rng.choice(40, 8, replace=False)
        count = rng.integers(1, 4, 8)
        bounds = it.bounds(number, count)
        exact = dense[:, number] @ count
        for node in range(len(bounds)):
            below = it.ids[it.lo[node]:it.hi[node]]
            assert exact[below].max() <= bounds[node]
            if it.child[node][0] < 0:
                assert (it.score(node, number, count) == exact[below]).all()
        best = lexical.Best(10)
        lexical.search([it], number, count, best)
        want = sorted(((int(s), i) for i, s in enumerate(exact) if s > 0), key=lambda r: (-r[0], r[1]))[:10]
        assert best.rows == want


def test_subtrees_are_pruned():
    """Documents in two far groups: only the group that holds the item's terms is scored."""
    o = np.repeat(np.arange(512), 2)
    number = np.where(np.arange(1024) < 512, np.arange(1024) % 4, 4 + np.arange(1024) % 4)
    entry = np.full(1024, 10 ** 9) + np.arange(1024)
    it = lexical.Tree.of(list(range(512)), o, number, entry, 8)
    best = lexical.Best(10)
    assert lexical.search([it], np.array([4, 5, 6, 7]), np.ones(4, np.int64), best) <= 256
    assert len(best.rows) == 10 and all(r[1] >= 256 for r in best.rows)


def test_norms_beyond_64_bits():
    stats = lexical.Statistics(10 ** 11, 10 ** 14, np.zeros(1, np.int64))
    n = np.array([1000, 5_000_000])
    assert [int(x) for x in stats.norms(n)] == [25 + 75 * int(x) * 10 ** 11 // 10 ** 14 for x in n]


def test_query_rows(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert got(catalog.QUERIES["op13_lexical_search"](spark, sf)) == brute(docs, items)


def test_edges(spark):
    items = [(1, "the lazy dog"), (2, None), (None, "mail"), (3, "ünïcödé")]
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as doc_id", "'x' as _item", "1 as rank")
    assert got(lexical.search_all(edge.documents(spark), q)) == brute(edge.ROWS, items)
    assert lexical.search_all(edge.empty(spark), q).collect() == []
    assert lexical.search_all(edge.documents(spark), q.limit(0)).collect() == []
