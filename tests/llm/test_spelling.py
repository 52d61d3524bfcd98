import random
import re
import zlib
from collections import Counter

import pytest

from lexitrend.llm import catalog
from lexitrend.llm import op11_spelling as spelling
from tests.llm import edge

LETTERS = "abcdeß÷éz"


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute(rows):
    count = Counter()
    for i, t in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            count[w] += 1
    n = {w: c for w, c in count.items() if len(w) >= 7 and c >= 2}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = {}
    for w in n:
        r = w
        while form[r] is not None:
            r = form[r]
        out[w] = (form[w], r, n[w], len(near[w]), n.get(form[w]))
    return out


def got(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def random_rows(seed: int, n_words: int = 60):
    rng = random.Random(seed)
    base = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(7, 10))) for _ in range(6)]
    words = set(base)
    while len(words) < n_words:
        w = list(rng.choice(sorted(words)))
        k = rng.randrange(len(w))
        what = rng.randrange(3)
        w[k:k + 1] = [] if what == 0 and len(w) > 7 else [rng.choice(LETTERS)] if what == 1 else [w[k], rng.choice(LETTERS)]
        words.add("".join(w))
    words = sorted(words)
    rows = []
    for i in range(300):
        chosen = [rng.choice(words) if rng.random() < .5 else base[int(rng.random() ** 3 * len(base))] for _ in range(30)]
        rows.append((i, ", ".join(w.upper() if rng.random() < .1 else w for w in chosen)))
    rows += [(None, " ".join(base * 3)), (5, None), (6, ""), (7, "short ab"), (7, "Twice1Twice")]
    return rows


@pytest.mark.parametrize("seed,block", [(1, 128), (2, 2), (3, 5), (4, 1)])
def test_against_brute_force(spark, seed, block):
    rows = random_rows(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows)
    assert len(want) > 30 and any(v[0] for v in want.values())
    assert got(spelling.variants(docs, max_block=block)) == want


def test_chains_are_followed_to_the_last_form(spark):
    rows = [(i, " ".join(["aaaaaaa"] * 1)) for i in range(6000)]
    words = [("aaaaaaab", 500), ("aaaaaabb", 40), ("aaaaabbb", 3)]
    rows += [(10_000 + k * 1000 + i, w) for k, (w, n) in enumerate(words) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, have = brute(rows), got(spelling.variants(docs))
    assert have == want
    assert have["aaaaabbb"][:2] == ("aaaaaabb", "aaaaaaa")


def test_query_against_brute_force_on_a_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute_by_deletion(rows)
    assert got(catalog.QUERIES["op11_spelling"](spark, sf)) == want


def brute_by_deletion(rows):
    """:func:`brute` with near words found by wildcards (the table has too many words for all pairs)."""
    count = Counter()
    for i, t in rows:
        for w, n in spelling.spelled(t or "", i).items():
            count[w.decode("latin-1")] += n
    n = {w: c for w, c in count.items() if c >= 2}
    by = {}
    for w in n:
        for k in range(len(w)):
            by.setdefault(w[:k] + "*" + w[k + 1:], set()).add(w)
    near = {w: set() for w in n}
    for w in n:
        for k in range(len(w)):
            near[w] |= by[w[:k] + "*" + w[k + 1:]]
            v = w[:k] + w[k + 1:]
            if v in n:
                near[w].add(v)
                near[v].add(w)
        near[w].discard(w)
    form = {}
    for w in n:
        best = min(near[w] - {w}, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = {}
    for w in n:
        r = w
        while form[r] is not None:
            r = form[r]
        out[w] = (form[w], r, n[w], len(near[w] - {w}), n.get(form[w]))
    return out


def test_blocks_are_bounded(spark):
    """Ten thousand words that share their first seven letters still meet in small blocks."""
    words = [("".join(["aaaaaaa"] + [LETTERS[(i // 9 ** k) % 9] for k in range(5)]), 2) for i in range(10_000)]
    df = spark.createDataFrame(words, "word string, n long")
    sizes = [r["n"] for r in spelling.blocks(df, 64).filter("hi - lo > 1").groupBy("block").agg(
        spelling.F.count("*").alias("n")).collect()]
    assert max(sizes) <= 64


def test_edges(spark):
    df = spelling.variants(edge.documents(spark))
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert got(df) == brute(edge.ROWS)
    assert spelling.variants(edge.empty(spark)).collect() == []
