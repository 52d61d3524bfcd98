"""Precision and recall of added spans on planted notations; none of the values is an example of the model."""

import random
from collections import Counter

import pytest

from lexitrend.llm import op9_pii as pii
from tests.llm.test_texts import luhn

LEADS = {"email": ("write to ", "mail ", "contact: ", "ask "), "ip": ("host ", "seen at ", "from ", "the node "),
         "card": ("paid with ", "card ", "charged to ", "number "), "phone": ("please call ", "tel ", "phone: ", "reach us ")}


class Plant:
    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def digits(self, n: int) -> str:
        return "".join(self.rng.choice("0123456789") for _ in range(n))

    def word(self, a: int, b: int) -> str:
        return "".join(self.rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(self.rng.randint(a, b)))

    def email(self) -> str:
        user, host = self.word(3, 9) + self.rng.choice(["", "." + self.word(3, 6), self.digits(2)]), self.word(3, 9)
        top = self.rng.choice(["org", "com", "de", "co.uk"])
        last = top.split(".")[-1]
        return self.rng.choice([f"{user} (at) {host}.{top}", f"{user}(at){host}.{top}", f"{user} [at] {host} [dot] {last}",
                                f"{user}[at]{host}.{top}", f"{user} @ {host}.{top}", f"{user} at {host} dot com",
                                f"{user} (at) {host} (dot) {last}"])

    def ip(self) -> str:
        g = [format(self.rng.randrange(1, 65536), "x") for _ in range(8)]
        return self.rng.choice([":".join(g), ":".join(g[:3]) + "::" + g[7], g[0] + "::" + ":".join(g[5:]),
                                "fe80::" + ":".join(g[4:]), ":".join(g).upper()])

    def card(self) -> str:
        while True:
            d = self.rng.choice("3456") + self.digits(15)
            if luhn(d):
                return self.rng.choice("./_").join(d[i:i + 4] for i in range(0, 16, 4))

    def phone(self) -> str:
        a, b, c = self.digits(3).replace("0", "3").replace("1", "4"), self.digits(3), self.digits(4)
        return self.rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"0{a}/{b}{c}", f"1-{a}-{b}-{c}",
                                f"({a}) {b} {c}", f"0{a} {b} {c}"])

    def decoy(self) -> str:
        d, w = self.digits, self.word
        return self.rng.choice([f"order {d(10)} of it", f"on 20{d(2)}-05-1{d(1)} 10-30 in", f"version {d(1)}.{d(2)}.{d(3)} now",
                                f"at 12:3{d(1)}:4{d(1)} we", f"mac 00:{d(2)}:{d(2)}:3c:4d:5e up", f"look at {w(3, 8)}. Then go",
                                f"isbn 978-3-16-{d(6)}-0 of", f"code {d(7)}.{d(7)} of", f"id {d(4)}.{d(4)}.{d(4)}.{d(4)} x",
                                f"met {w(3, 6)} @ 5.30 pm", f"std::vector {w(2, 4)}::{w(2, 4)} x", f"sum {d(3)}.{d(3)},{d(2)} paid"])


@pytest.mark.parametrize("seed", [11, 12])
def test_precision_and_recall_by_kind(spark, seed):
    plant, docs, want = Plant(seed), [], {}
    for i in range(2000):
        start = plant.word(2, 8) + " "
        if i % 5 == 4:
            docs.append((i, start + plant.decoy()))
            continue
        kind = pii.KINDS[i % 5]
        start += plant.rng.choice(LEADS[kind])
        value = getattr(plant, kind)()
        docs.append((i, start + value + plant.rng.choice([" now", ", and", "", ". Then"])))
        want[i] = f"{kind}:{len(start)}:{len(start) + len(value)}"
    found, right, planted = Counter(), Counter(), Counter(w.split(":")[0] for w in want.values())
    for r in pii.find(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        for span in filter(None, r["spans"].split(",")):
            kind = span.split(":")[0]
            found[kind] += 1
            right[kind] += want.get(r["doc_id"]) == span
    for kind in pii.KINDS:
        assert right[kind] / planted[kind] >= 0.95 and right[kind] / found[kind] >= 0.93, (kind, right, found, planted)


def test_features_are_those_of_whole_values(spark):
    user = "u" * 80
    docs = [(1, f"mail {user}@host.example.org now"), (2, f"mail {user}42 (at) example.org now")]
    rows = pii.candidates(spark.createDataFrame(docs, "doc_id long, text string"))
    values = {r["value"] for r in pii.rewritten(rows).collect()}
    assert f"{user} (at) host.example.org" in values
    assert {(r["wide"], r["digits"]) for r in pii.with_features(rows).collect() if r["_doc"] == 2 and r["wide"]} == {(1, 2)}
    assert [r["spans"] for r in pii.find(spark.createDataFrame(docs[1:], "doc_id long, text string")).collect()] == [f"email:5:{5 + 80 + 19}"]
