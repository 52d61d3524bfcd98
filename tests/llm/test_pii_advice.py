import hashlib
import random

import pytest

from lexitrend.llm import op9_pii as pii
from tests.llm.test_texts import luhn, slow_spans


def found(spark, texts: list[str]) -> list:
    rows = pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return sorted(rows, key=lambda r: r["doc_id"])


def test_parts_of_very_many_digits(spark):
    texts = ["9" * 40 + ".1.1.1", "1.1.1." + "0" * 60 + "7", "0" * 60 + "256.1.1.1", "host 10.0.0.1 up"]
    for text, r in zip(texts, found(spark, texts)):
        assert r["base_sha256"] == hashlib.sha256(slow_spans(text).encode()).hexdigest(), text
        assert r["n_ip"] == slow_spans(text).count("ip:"), text


OTHERS = ["please call (202) 555-01{:02d} now", "write to jane{} (at) example.org or look.", "paid with {} on it"]


def dotted_card(rng) -> str:
    while True:
        d = "4" + "".join(rng.choice("0123456789") for _ in range(15))
        if luhn(d):
            return ".".join(d[i:i + 4] for i in range(0, 16, 4))


@pytest.mark.parametrize("n", [0, 1, 30, 400])
def test_many_spans_in_other_notations_are_all_found(spark, n):
    """They are no look-alikes of themselves, and no number of base spans is needed."""
    rng = random.Random(n)
    base = [f"please call +1 (20{i % 10}) 555-0{i % 900 + 100} or mail u{i}@host{i % 7}.com, "
            f"card {dotted_card(rng).replace('.', ' ')}." for i in range(n)]
    m = max(5, n)
    texts = base + [OTHERS[0].format(i % 100) for i in range(m)] + [OTHERS[1].format(i) for i in range(m)] \
        + [OTHERS[2].format(dotted_card(rng)) for _ in range(m)] + ["we met x @ 5.30 pm", "he was at the dot matrix"]
    got = [r["spans"] for r in found(spark, texts)][n:]
    assert got[:m] == ["phone:12:26"] * m
    assert got[m:2 * m] == [f"email:9:{30 + len(str(i))}" for i in range(m)]
    assert got[2 * m:3 * m] == ["card:10:29"] * m
    assert got[3 * m:] == ["", ""]


def test_prior_decides_alike_at_every_size(spark):
    for n in (1, 200):
        got = found(spark, ["order 1234567890 of it", "code 1234567.1234567 of it", "on 2024-01-15 10-30 in"] * n)
        assert {r["spans"] for r in got} == {""}


@pytest.mark.parametrize("n", [0, 300])
def test_ipv6_addresses_are_added(spark, n):
    base = [f"the host 10.1.{i % 256}.{i % 100} is up" for i in range(n)]
    good = ["2001:db8::1", "fe80::1", "::1", "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "2001:DB8:0:0:8:800:200C:417A",
            "2a02:810d:1:2::7", "2001:db8::"]
    texts = [f"seen at {a}{end}" for a in good for end in (" today", ".", "/64", "%eth0", " or")]
    texts += ["seen at fe80::1: ok"]
    texts += ["inet6 addr:fe80::1 up"]
    bad = ["at 12:30:45 now", "mac 00:1a:2b:3c:4d:5e x", "std::vector<int> a::b", "f :: Int -> Int", "1::2::3", "1:2:3:4:5:6:7:8:9",
           "1:2:3:4:5:6:7 8", "12345::1", ":::", "1:2:3:4::5:6:7:8"]
    got = [r["spans"] for r in found(spark, base + texts + bad)][n:]
    want = [f"ip:8:{8 + len(a)}" for a in good for _ in range(5)] + ["ip:8:15", "ip:11:18"]
    assert got[:len(texts)] == want
    assert got[len(texts):] == [""] * len(bad)
