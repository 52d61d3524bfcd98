import collections
import hashlib
import random

import numpy as np
import pytest

from lexitrend.llm import op1_near_dedup as near
from lexitrend.llm import op7_exact_dedup as exact
from lexitrend.llm.common import table
from lexitrend.llm.components import components
from tests.llm import edge

SF = "/root/testdata/sf0.001"


def test_chunks_put_the_text_together(spark):
    from pyspark.sql import functions as F

    docs = edge.documents(spark, clash=False).filter("text is not null")
    for r in docs.select("text", exact.chunks(F.col("text")).alias("c")).collect():
        assert "".join(r["c"]) == r["text"]
        assert all(len(c) <= exact.MAX_CHARS for c in r["c"])


def test_exact_groups_against_brute_force(spark):
    got = sorted(map(tuple, exact.exact_groups(edge.documents(spark)).collect()), key=str)
    groups = collections.defaultdict(list)
    for i, t in edge.ROWS:
        groups[t or ""].append(i)
    want = []
    for i, t in edge.ROWS:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        want.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_exact_keep_one_keeps_columns(spark):
    docs = edge.documents(spark)
    kept = exact.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(x for (x,) in kept.select("doc_id").collect() if x is not None) == [2, 4, 6, 6, 6, 7, 8, 9, 10]
    assert exact.exact_groups(edge.empty(spark)).collect() == []


def test_exact_matches_oracle(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = sorted(map(tuple, con.execute(exact.ORACLE).fetchall()))
    assert sorted(map(tuple, exact.exact_groups(table(spark, SF, "documents")).collect())) == want


def test_estimate_and_exact_probability_jaccard():
    rng = random.Random(1)
    base = [f"w{rng.randrange(3000)}" for _ in range(500)]
    texts = [" ".join(base)]
    for edits in (1, 4, 10, 40):
        other = list(base)
        for k in rng.sample(range(500), edits):
            other[k] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(other + base[:50]))
    doc, shingle, weight = near.shingles(texts)
    sig = near.prob_min_hash(doc, shingle, weight, len(texts), 1024)
    cut = np.searchsorted(doc, np.arange(len(texts) + 1))
    for i in range(1, len(texts)):
        a, b = slice(cut[0], cut[1]), slice(cut[i], cut[i + 1])
        jp = near.probability_jaccard(shingle[a], weight[a], shingle[b], weight[b])
        x, y = dict(zip(shingle[a], weight[a])), dict(zip(shingle[b], weight[b]))
        union = set(x) | set(y)
        slow = sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in union) for d in set(x) & set(y))
        assert jp == pytest.approx(slow)
        assert abs((sig[0] == sig[i]).mean() - jp) < 0.07


def _brute(texts: list[str], threshold: float = near.THRESHOLD) -> list[int]:
    doc, shingle, weight = near.shingles(texts)
    cut = np.searchsorted(doc, np.arange(len(texts) + 1))
    sets = [(shingle[cut[i]:cut[i + 1]], weight[cut[i]:cut[i + 1]]) for i in range(len(texts))]
    keys = [set(s.tolist()) for s, _ in sets]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            same = texts[i] == texts[j] if not keys[i] or not keys[j] else (
                len(keys[i] & keys[j]) >= 0.3 * len(keys[i] | keys[j])
                and near.probability_jaccard(*sets[i], *sets[j]) >= threshold - 1e-9)
            if same and find(i) != find(j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))]


def test_near_classes_against_brute_force_with_a_chain(spark):
    """A chain of texts, each like the next but not like those further on, is one class."""
    rng = random.Random(2)
    words = [f"w{rng.randrange(5000)}" for _ in range(300)]
    texts = []
    for k in range(60):
        texts.append(" ".join(words))
        for p in range(4 * k, 4 * k + 4):
            words[p % 300] = f"n{rng.randrange(10**6)}"
    shared = " ".join(f"s{rng.randrange(5000)}" for _ in range(100))
    texts += [shared + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(120)) for _ in range(60)]
    texts += ["", "", "!!", "!!", "one two", "One, two!", "two one", texts[3].upper()]
    rng.shuffle(texts)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: r["class_id"] for r in near.near_classes(df).collect()}
    want = _brute(texts)
    assert [got[i] for i in range(len(texts))] == want


def test_second_round_joins_all_components_of_a_bucket(spark):
    """Without any link of the first round, the blocks alone find every class."""
    rng = random.Random(7)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    texts = []
    for k in range(70):
        words = list(base)
        for p in rng.sample(range(120), 3 if k % 3 else 1):
            words[p] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(words + (["twice and twice again here"] * 3 if k % 5 == 0 else [])))
    roots = {i: 0 if i < 20 else 20 if i < 26 else i for i in range(70)}
    rows = spark.createDataFrame([(i, 1, roots[i], t) for i, t in enumerate(texts)],
                                 "_row long, _cluster long, _root long, _text string")
    found = near._exact_links(rows, near.THRESHOLD, block_chars=4000).collect()
    doc, shingle, weight = near.shingles(texts)
    cut = np.searchsorted(doc, np.arange(71))
    like = lambda i, j: near.probability_jaccard(shingle[cut[i]:cut[i + 1]], weight[cut[i]:cut[i + 1]],
                                                 shingle[cut[j]:cut[j + 1]], weight[cut[j]:cut[j + 1]])
    assert found and all(like(r["u"], r["v"]) >= near.THRESHOLD - 1e-9 for r in found)

    def classes(links):
        up = dict(roots)
        def find(i):
            while up[i] != i:
                i = up[i]
            return i
        for i, j in links:
            up[max(find(i), find(j))] = min(find(i), find(j))
        return [find(i) for i in range(70)]

    every = [(i, j) for i in range(70) for j in range(i) if like(i, j) >= near.THRESHOLD - 1e-9]
    assert classes([(r["u"], r["v"]) for r in found]) == classes(every)


def test_estimates_put_components_into_clusters(spark):
    placed = spark.createDataFrame([(1, i, 0 if i < 30 else i) for i in range(40)], "_bucket long, _row long, _root long")
    sigs = spark.createDataFrame([(i, bytes([i % 7] * 16)) for i in range(40)], "_row long, _sig binary")
    got = {tuple(sorted(r)) for r in near._near_roots(placed, sigs, block=4).collect()}
    root = [0 if i < 30 else i for i in range(40)]
    allowed = {tuple(sorted((root[i], root[j]))) for i in range(40) for j in range(i) if root[i] != root[j] and i % 7 == j % 7}
    assert got <= allowed and {x for e in got for x in e} == {x for e in allowed for x in e}


def test_near_edges_and_empty(spark):
    docs = edge.documents(spark)
    got = near.near_classes(docs).collect()
    assert len(got) == len(edge.ROWS)
    by = collections.Counter((r["class_id"], r["class_size"]) for r in got)
    assert by[(1, 2)] == 2 and by[(5, 2)] == 2 and by[(6, 2)] == 2 and by[(None, 2)] == 2 and by[(3, 2)] == 2
    assert sum(r["kept"] for r in got) == len(edge.ROWS) - 5
    assert near.keep_one(docs).columns == docs.columns
    assert near.near_classes(edge.empty(spark)).collect() == []


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 130)] + [(7, i) for i in range(8, 40)] + [(5, 5), (40, 39), (39, 40)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {**{i: 100 for i in range(100, 131)}, **{i: 7 for i in range(7, 41)}}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
