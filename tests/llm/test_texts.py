import hashlib
import html
import itertools
import random
import re

import pytest

from lexitrend.llm import op3_licenses as lic
from lexitrend.llm import op5_decontaminate as deco
from lexitrend.llm import op9_pii as pii
from lexitrend.llm import op10_html_extract as web
from lexitrend.llm.common import table
from tests.llm import edge

SF = "/root/testdata/sf0.01"

# --- licences ---------------------------------------------------------------------------------

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this
# software, to deal in it. The above copyright notice and this permission notice shall be included.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY. In no event shall the authors be liable."""


@pytest.mark.parametrize("text,want", [
    ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
    ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"]),
    ("Licensed under the Apache License, Version 2.0.", ["Apache-2.0"]),
    ("Released under the MIT License.", ["MIT"]),
    ("// SPDX-License-Identifier: GPL-2.0-or-later", ["GPL-2.0-or-later"]),
    (MIT, ["MIT"]),
    ("GNU Lesser General Public License as published; either version 2.1 of the License, or (at your option) any later version.",
     ["LGPL-2.1-or-later"]),
    ("The 3-clause BSD license. Also the ISC license.", ["BSD-3-Clause", "ISC"]),
    ("Nothing of that kind.", []),
])
def test_licence_sentences(text, want):
    assert lic.licences(lic.identifiers(text)[0]) == want


def test_licences_in_the_table(spark):
    lines = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "the GNU General Public License, version 3.": "GPL-3.0",
             "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT"}
    got = {r["doc_id"]: r for r in lic.scan(table(spark, SF, "documents")).collect()}
    hits = 0
    for r in table(spark, SF, "documents").collect():
        want = {name for line, name in lines.items() if line in (r["text"] or "")}
        assert want <= set(got[r["doc_id"]]["licenses"].split(","))
        hits += len(want)
    assert hits > 5


def test_licence_edges(spark):
    got = lic.scan(edge.documents(spark)).collect()
    assert len(got) == len(edge.ROWS) and {r["licenses"] for r in got} == {""}
    assert lic.identifiers("Under the licence of nobody.") == ([], 1)
    assert lic.scan(edge.empty(spark)).collect() == []


# --- decontamination ----------------------------------------------------------------------------

def slow_distance(pattern: str, text: str) -> int:
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def test_myers_against_dynamic_programming():
    rng = random.Random(0)
    for _ in range(200):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 90)))
        b = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 60)))
        assert deco.myers(a, b)[0] == slow_distance(a, b)


def edits(rng: random.Random, text: str, n: int) -> str:
    out = list(text)
    for _ in range(n):
        k = rng.randrange(len(out))
        out[k:k + 1] = rng.choice([[], ["q"], [out[k], "z"]])
    return "".join(out)


def test_matches_against_brute_force(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    items = [(i, " ".join(word() for _ in range(rng.randrange(3, 40)))) for i in range(25)] + [(90, None), (91, ""), (92, "!!"), (3, "abc")]
    docs = []
    for d in range(120):
        text = " ".join(word() for _ in range(rng.randrange(0, 60)))
        if d % 2:
            base = items[d % 25][1]
            k = int(len(base) * deco.ERROR_RATE)
            text += " " + edits(rng, base, rng.choice([0, k, k + 1, 3 * k + 3])).upper() + " " + word()
        docs.append((d, text))
    got = {(r["doc_id"], r["item_id"], r["item_chars"]): r["distance"] for r in deco.matches(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"), block_chars=700).collect()}
    want = {}
    for (d, t), (i, b) in itertools.product(docs, items):
        b = deco.normalise(b)
        n = slow_distance(b, deco.normalise(t)) if b else 1
        if b and n <= int(len(b) * deco.ERROR_RATE):
            want[d, i, len(b)] = n
    assert got == want and len(want) > 30


def test_every_benchmark_passage_is_found(spark):
    items = table(spark, SF, "benchmark")
    docs = table(spark, SF, "documents")
    got = {r["doc_id"] for r in deco.matches(docs, items).collect()}
    texts = [r["text"] for r in items.collect()]
    want = {r["doc_id"] for r in docs.collect() if any(t in (r["text"] or "") for t in texts)}
    assert want and want <= got
    left = {r["doc_id"] for r in deco.drop_contaminated(docs, items).collect()}
    assert left == {r["doc_id"] for r in docs.collect()} - got


def test_decontamination_edges(spark):
    docs, items = edge.documents(spark), spark.createDataFrame([(1, "quick brown fox jumps over"), (2, None)], "item_id int, text string")
    got = deco.matches(docs, items).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 2]
    kept = deco.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(edge.ROWS) - 2
    assert deco.matches(edge.empty(spark), items).collect() == []
    none = edge.empty(spark, "item_id int, text string")
    assert deco.matches(docs, none).collect() == [] and deco.drop_contaminated(docs, none).count() == len(edge.ROWS)


# --- personal data --------------------------------------------------------------------------------

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits: str) -> bool:
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def slow_spans(text: str) -> str:
    out = []
    for k, (kind, p) in enumerate(PLAIN.items()):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                    "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]:
                out.append((m.start(), k, kind, m.end()))
    return ",".join(f"{c}:{a}:{e}" for a, _, c, e in sorted(out))


TRICKY = ["a@b.c_x@y.com", "a@b..c", "1.2.3.4.5 256.1.1.1 01.02.03.004", "4111 1111 1111 1111 and 4111-1111-1111-1112",
          "+1 (988) 555-2485 4532015112830366", "é+49 30 1234567 x", "@" * 20 + "x@y.z", "+1+2 3 4 5 6 7 8 9 0 1 2",
          "😀 x@y.com 😀 1.1.1.1", "%_a@b-.c-d.e", "0.0.0.0.0.0.0.0", "4" * 200, "1 - 2", "a@b.c@d.e"]


def test_base_spans_against_plain_patterns(spark):
    rng = random.Random(1)
    odd = ["".join(rng.choice("a1.@+ -()4_é") for _ in range(rng.randrange(60))) for _ in range(400)]
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    docs += [(10**6 + i, t) for i, t in enumerate(TRICKY + odd)]
    got = {r["doc_id"]: r for r in pii.find(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, t in docs:
        want = slow_spans(t or "")
        assert got[i]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), t
        assert set(filter(None, want.split(","))) <= set(got[i]["spans"].split(","))
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [want.count(k + ":") for k in pii.KINDS]


def test_long_runs_do_not_overflow(spark):
    docs = [(1, "9" * 100_000), (2, "a" * 100_000), (3, "1 " * 50_000), (4, "1." * 50_000), (5, "a." * 50_000 + "@b.c")]
    assert pii.find(spark.createDataFrame(docs, "doc_id long, text string")).count() == 5


def test_trees_add_spans_in_other_notations(spark):
    """Enough ordinary data to learn from: a national number and a spelt-out address are added."""
    rng = random.Random(2)
    docs = []
    for i in range(300):
        n = "".join(rng.choice("0123456789") for _ in range(7))
        docs.append((i, f"please call +1 (20{i % 10}) {n[:3]}-{n[3:]} or mail u{i}@host{i % 7}.com ref x{n}{n}y and a code {n}.{n} of it"))
    docs.append((1000, "please call (202) 555-0137 now"))
    docs.append((1001, "write to jane.doe (at) example.org or look at it. Then go."))
    got = {r["doc_id"]: r for r in pii.find(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[1000]["n_phone"] == 0 and got[1000]["spans"] == "phone:12:26" and got[1000]["n_added"] == 1
    assert got[1001]["spans"] in ("email:9:34", "")    # e-mails have no failed look-alikes here to learn from


def test_prose_gets_no_added_spans(spark):
    got = pii.find(table(spark, "/root/testdata/sf0.1", "documents"))
    assert got.filter("n_added > 0").count() == 0


def test_pii_edges(spark):
    from pyspark.sql import functions as F

    docs = edge.documents(spark)
    got = pii.find(docs).collect()
    assert len(got) == len(edge.ROWS)
    ten = next(r for r in got if r["doc_id"] == 10)
    assert [ten[f"n_{k}"] for k in pii.KINDS] == [1, 1, 1, 1]
    text = dict(edge.ROWS)[10]
    out = spark.createDataFrame([(text, ten["spans"])], "t string, s string").select(pii.redact(F.col("t"), F.col("s"))).first()[0]
    assert out == "mail [EMAIL] or call [PHONE], host [IP], card [CARD]"
    empty_sha = hashlib.sha256(b"").hexdigest()
    assert all(r["base_sha256"] == empty_sha and r["spans"] == "" for r in got if r["doc_id"] in (3, 4))
    assert pii.find(edge.empty(spark)).collect() == []


# --- pages ------------------------------------------------------------------------------------------

def article(page: str) -> str:
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
    return "\n".join(b for b in blocks if b)


def test_pages_give_their_article(spark):
    pages = table(spark, SF, "pages")
    got = {r["page_id"]: r for r in web.extract(pages).collect()}
    for r in pages.collect():
        assert got[r["page_id"]]["text"] == article(r["html"])
        assert got[r["page_id"]]["n_chars"] == len(article(r["html"]))


PAGE = """<html><head><title>T</title></head><body><header><h1>Site</h1><nav><a href=/>Home</a></nav></header>
<div id="cookie-notice">We use cookies.</div><div class="content"><h1>A title &amp; more</h1>
<p>A long first paragraph with a number of words, that is fine and&nbsp;goes on &lt;here&gt;.</p>
<ul><li>item one of the list.<li>item two</ul><script>if (a<b) "</p>"</script><form><label>Name</label></form><p>Short.</p>
<div class="comments"><p>I love this long comment because it is written with many many words and so on.</p></div></div>
<aside>Related things to read</aside><footer>&copy; foo</footer><!-- </body> -->"""


def test_boilerplate_is_left_out():
    assert web.main_text(PAGE) == ("A title & more\nA long first paragraph with a number of words, that is fine and goes on "
                                   "<here>.\nitem one of the list.\nitem two\nShort.")


def test_min_cut_against_all_labellings():
    rng = random.Random(4)
    for _ in range(150):
        n = rng.randrange(1, 9)
        net = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [{} for _ in range(n)]
        for i, j in itertools.combinations(range(n), 2):
            if rng.random() < 0.5:
                edges[i][j] = edges[j][i] = rng.uniform(0, 2)

        def cost(labels):
            return (sum(max(0, x) for x, k in zip(net, labels) if not k) + sum(max(0, -x) for x, k in zip(net, labels) if k)
                    + sum(w for i in range(n) for j, w in edges[i].items() if labels[i] and not labels[j]))

        best = min(cost(x) for x in itertools.product((False, True), repeat=n))
        assert cost(web.min_cut(net, edges)) == pytest.approx(best)


def test_page_edges(spark):
    pages = [(1, "u", None), (2, None, ""), (None, "u", "<p>a&nbsp;b"), (3, "u", "<<<>< </p> <!-- x"), (3, "u", "no tags at all, just some words."),
             (4, "u", "<article><p>" + "many words here. " * 20_000 + "</article>"), (5, "u", "<script>x")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    from pyspark.sql import functions as F
    got = web.extract(df.withColumns({c: F.lit(1) for c in ("text", "n_chars", "_x")})).collect()
    assert len(got) == len(pages) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert sum(r["n_chars"] > 300_000 for r in got) == 1
    assert web.extract(edge.empty(spark, "page_id long, url string, html string")).collect() == []
