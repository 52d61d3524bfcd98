"""Personal data: base patterns, candidates and gradient-boosted trees, in DataFrame functions.

Base spans (e-mail, IPv4, card, phone) come from fixed patterns and checks and always stay.
High-recall generators propose further, overlapping spans: e-mails written with ``(at)`` or
spaces, IPv6 addresses (``::`` forms too; an IPv4 tail is a base span of its own), card-like and phone-like runs of digits in other notations. Every
candidate has small integer features of its format and of the text around it. Positive examples
are the base spans rewritten in those other notations, in their own context; negative ones are
refuted matches: failed base matches, and the generators' matches that are not plausible, glued to
letters or digits, or touch a failed base match. Free matches that nothing refutes may well be
real, so they are no examples at all. A Luhn failure counts 1/9: for nine of them, one number passes
by chance. Fixed examples of both sorts (``PRIOR``) come first, and a kind's examples of either sort
from the data are scaled down to the weight of its fixed ones, so a kind behaves alike at
every size. The examples are counted
per feature vector in Spark, so the trees are grown on the driver from a table whose size is
bounded by the product of the bins, not by the data. A kind's score is calibrated by the examples' shares per score, and its threshold is
half-way between the least one with the wanted precision and the next below it. The trees are applied as one SQL expression; spans at
or above their kind's threshold are added if they are plausible (digits, Luhn), overlap no base
span, no failed base match of their kind and no span to their left.

Positions come from ``split`` and ``regexp_extract_all``: the lengths of the parts between
matches and of the matches before one, summed by a window per row and pattern, so a text with
very many matches stays linear. The patterns are written so that Java's matcher is linear and
does not recurse on long runs; they match what the plain patterns match.

Results that are fixed here:

- a null text is an empty text: counts 0, ``spans`` empty, ``base_sha256`` that of no text;
- every row gives one row, repeated and null ids too; further columns are ignored;
- ``n_*`` count base spans, ``n_added`` the added ones; ``spans`` lists both;
- a kind without any example in the data is judged by the fixed examples alone;
- an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

KINDS = ("email", "ip", "card", "phone")

# --- fixed values: base patterns, with possessive runs (nothing after them can match less) -----
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A number up to 255, after any zeros: compared as text, since a part may have very many digits.
OCTET = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])$"
#: Further generators. All repetitions of groups are bounded or possessive.
WIDE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++(?:\x20?(?:\(at\)|\[at\]|@)\x20?[a-z0-9-]++"
             r"(?:(?:\x20?(?:\(dot\)|\[dot\])\x20?|\.)[a-z0-9-]++)++"
             r"|\x20at\x20[a-z0-9-]++(?:\x20dot\x20[a-z0-9-]++)++)",
    "ip": r"(?<![0-9A-Za-z]|[0-9A-Fa-f:]:)(?!:[^:])(?:[0-9A-Fa-f]{0,4}:){2,8}[0-9A-Fa-f]{0,4}(?<![^:]:)"
          r"(?![0-9A-Za-z]|:[0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9](?:[\x20./_-]{0,2}[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9+])(?:00)?\(?[0-9][\x20().0-9/-]{7,18}[0-9](?![0-9])",
}
#: An IPv6 address: eight groups, or (with at most seven, see ``candidates``) one ``::`` and some group.
IPV6 = (r"^(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=.*[0-9A-Fa-f])(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4})*)?"
        r"::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4})*)?)$")
#: What an e-mail in another notation must end in, and what is prose rather than an address.
TOP = r"(?i)[. )\]](?:[a-z]{2,24}|xn--[a-z0-9-]+)$"
PROSE = r"(?i)\x20at\x20(?:an?|the|this|that|one|each|every|my|your|his|her|its|our|their)\x20dot\x20"
CUES = {
    "email": r"(?i)mail|contact|write|e-?post|correo|courriel",
    "ip": r"(?i)\bip\b|host|server|addr",
    "card": r"(?i)card|visa|master|credit|karte|carte|tarjeta|payment",
    "phone": r"(?i)phone|tel|call|mobile|fax|whatsapp|telefon|t[ée]l[ée]f",
}
FEATURES = ("kind", "wide", "digits", "letters", "marks", "groups", "longest", "before", "after", "cue", "lead", "double")

TREES, DEPTH, RATE = 40, 3, 0.3
PRECISION = 0.98
#: Fixed examples: kind, whether it is personal data, text before, match, text after; and the weight of each.
PRIOR: tuple[tuple[str, bool, str, str, str], ...] = (
    ("email", True, "please write to ", "jane.doe (at) example.org", " or "),
    ("email", True, "the list of ", "bob42 @ mail.example.com", ", an"),
    ("email", True, "contact: ", "info [at] example [dot] com", ". Th"),
    ("email", True, "as told to ", "anna at example dot com", " las"),
    ("email", True, "mail ", "max.m(at)firma.de", ""),
    ("email", True, "", "x_1 [at] host3 [dot] co [dot] uk", " on "),
    ("email", False, "we met ", "x @ 5.30", " pm "),
    ("email", False, "the price ", "3 @ 1.25", " eac"),
    ("email", False, "qu\u00e9", "bob (at) example.org", "\u00e9 a"),
    ("card", True, "paid with card ", "4111.1111.1111.1111", " on "),
    ("card", True, "number ", "4111/1111/1111/1111", ". Th"),
    ("card", True, "and ", "5500_0000_0000_0004", " or "),
    ("card", True, "visa ", "4111-1111 1111-1111", ""),
    ("card", True, "amex ", "3782.822463.10005", ", an"),
    ("card", False, "value ", "12.345678901234", " of "),
    ("card", False, "days ", "20240115/20240116", " and"),
    ("card", False, "code ", "1234567.1234567", " of "),
    ("card", False, "ref\u00e9", "4111.1111.1111.1111", "\u00e9 a"),
    ("phone", True, "please call ", "(202) 555-0137", " now"),
    ("phone", True, "reach us: ", "202-555-0137", ". Th"),
    ("phone", True, "and ", "202.555.0137", " or "),
    ("phone", True, "reach us ", "(202) 555 0137", " on "),
    ("phone", True, "ring me at ", "1-202-555-0137", ". Th"),
    ("phone", True, "our number ", "0301/2345678", ""),
    ("phone", True, "Tel. ", "0049 30 12345678", ""),
    ("phone", True, "Telefon ", "030/12345678", ", un"),
    ("phone", False, "code ", "1234567.1234567", " of "),
    ("phone", False, "on ", "2024-01-15 10-30", " in "),
    ("phone", False, "ISBN ", "978-3-16-148410-0", ". Th"),
    ("phone", False, "order ", "1234567890", " of "),
    ("phone", False, "at ", "1700000000000", " the"),
    ("phone", False, "days ", "20240115-20240116", " and"),
)
PRIOR_WEIGHT = 20
IPV6_FORMS = ("2001:db8::1", "::1", "fe80::1", "fe80::1ff:fe23:4567:890a", "2001:db8:0:1::c0a8:101", "2001:db8::",
              "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "2a00:1450:4001:81b::200e", "2001:db8:1::5", "fdaa::1:2:3",
              "fd12:3456::a1b2", "2001:db8:aa:bb::cc:dd", "FD00:AB:CD:EF:1:22:333:4444")
PRIOR += tuple(("ip", True, left, form, " on ") for form in IPV6_FORMS for left in ("host ", "the list of "))
PRIOR += tuple(("ip", False, left, form, " on ") for left in ("host ", "the list of ") for form in (
    "12:30:45", "00:1a:2b:3c:4d:5e", "01:02:03:04", "a::b", "be::ad", "dead::beef", "1:2:3:4:5:6:7"))


def _matches(text: Column, kind: str, pattern: str, wide: int) -> Column:
    """One struct per match: generator, place in the generator's order, lengths and context."""
    some = text.contains("@") if kind == "email" and not wide else text.contains("+") if kind == "phone" and not wide \
        else text.contains("::") | text.rlike("[0-9A-Fa-f]:[0-9A-Fa-f]") if kind == "ip" and wide \
        else text.rlike(r"(?i)@|\(at\)|\[at\]|\x20at\x20") if kind == "email" else text.rlike("[0-9]")
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    rows = F.transform(F.arrays_zip(found.alias("m"), F.slice(gaps, 1, F.size(found)).alias("g"),
                                    F.slice(gaps, 2, F.size(found)).alias("h")), lambda x: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), F.lit(wide).alias("wide"),
        x["m"].alias("value"), F.length(x["g"]).cast("long").alias("gap"),
        F.right(x["g"], F.lit(24)).alias("left"), F.substring(x["h"], 1, 4).alias("right")))
    rows = F.transform(rows, lambda x, i: x.withField("at", i))
    return F.when(some, rows)


def _luhn(digits: Column) -> Column:
    """Whether the digits pass Luhn's check (for values of at most 19 digits)."""
    reverse = F.split(F.reverse(digits), "")
    total = F.aggregate(F.transform(reverse, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2))),
        F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return total % 10 == 0


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_row, _doc`` and, for each candidate, its span, whether it is valid, and its features;
    a row without candidates appears once, with null span."""
    text = F.col("_text")
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_doc"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    empty = F.array().cast("array<struct<kind:int,wide:int,value:string,gap:bigint,left:string,right:string,at:int>>")
    every = [F.coalesce(_matches(text, k, p, w), empty) for w, table in ((0, BASE), (1, WIDE)) for k, p in table.items()]
    flat = rows.select("_row", "_doc", F.explode_outer(F.concat(*every)).alias("c")).select("_row", "_doc", "c.*")
    before = Window.partitionBy("_row", "kind", "wide").orderBy("at")
    size = F.length("value").cast("long")
    start = F.sum("gap").over(before) + F.sum(size).over(before) - size
    digits = F.regexp_replace("value", "[^0-9]", "")
    n = F.length(digits)
    octets = F.split("value", r"\.")
    valid = F.when(F.col("wide") == 1, F.lit(False)).when(F.col("kind") == 0, F.lit(True)).when(
        F.col("kind") == 1, F.forall(octets, lambda p: p.rlike(OCTET))).when(
        F.col("kind") == 2, n.between(14, 19) & _luhn(F.substring(digits, 1, 19))).otherwise(n.between(10, 15))
    # What a span in another notation must still satisfy, and base matches that speak against one.
    plausible = F.when(F.col("kind") == 0, F.col("value").rlike(TOP) & ~F.col("value").rlike(PROSE)).when(F.col("kind") == 2, n.between(14, 19) & _luhn(F.substring(digits, 1, 19))).when(
        F.col("kind") == 3, n.between(10, 15)).when((F.col("kind") == 1) & (F.col("wide") == 1), F.col("value").rlike(IPV6) & (
            ~F.col("value").contains("::") | (F.size(F.filter(F.split("value", ":"), lambda g: g != "")) <= 7))).otherwise(F.lit(True))
    return flat.withColumns({"start": start, "valid": valid, "plausible": plausible,
                             "failed": (F.col("wide") == 0) & ~valid & (n >= 10)}).select(
        "_row", "_doc", "kind", "wide", "start", (F.col("start") + size).alias("end"), "valid", "plausible", "failed",
        "value", "left", "right")


def with_features(found: DataFrame) -> DataFrame:
    """Small integers for a candidate's format and context; each has few possible values."""
    parts = F.split("value", "[^A-Za-z0-9]+")
    cue = F.lit(0)
    for k, p in enumerate(CUES.values()):
        cue = F.when((F.col("kind") == k) & F.col("left").rlike(p), 1).otherwise(cue)

    def count(pattern: str, most: int) -> Column:
        return F.least(F.length(F.regexp_replace("value", pattern, "")), F.lit(most))

    return found.withColumns({
        "digits": count("[^0-9]", 20), "letters": count("[^A-Za-z]", 30), "marks": count("[A-Za-z0-9]", 10),
        "groups": F.least(F.size(parts), F.lit(8)),
        "longest": F.least(F.array_max(F.transform(parts, lambda p: F.length(p))), F.lit(20)),
        "before": F.col("left").rlike(r"[\p{L}\p{N}]$").cast("int"),
        "after": F.col("right").rlike(r"^[\p{L}\p{N}]").cast("int"), "cue": cue,
        "lead": F.col("value").rlike("^[+(0]").cast("int"), "double": F.col("value").contains("::").cast("int")})


def rewritten(found: DataFrame) -> DataFrame:
    """Base spans in the notations the further generators look for, as positive examples."""
    value, kind = F.col("value"), F.col("kind")
    digits = F.regexp_replace(value, "[^0-9]", "")
    # IPv4 spans give their places to valid IPv6 spellings.
    forms = F.when(kind == 1, F.array(*map(F.lit, IPV6_FORMS))).when(kind == 0, F.array(F.regexp_replace(value, "@", " (at) "), F.regexp_replace(value, "@", "(at)"), F.regexp_replace(value, "@", " @ "),
                                      F.regexp_replace(F.regexp_replace(value, "@", " [at] "), r"\.", " [dot] "))).when(
        kind == 2, F.array(F.regexp_replace(digits, "([0-9]{4})(?=[0-9])", "$1."),
                           F.regexp_replace(digits, "([0-9]{4})(?=[0-9])", "$1/"))).when(
        kind == 3, F.array(F.regexp_replace(value, r"^\+[0-9]{1,3}[\x20-]+", ""), F.regexp_replace(value, r"^\+", "00")))
    return found.filter("wide = 0 and valid").withColumn("value", F.explode(forms)).withColumn("wide", F.lit(1))


# --- boosted trees on counted feature vectors --------------------------------------------------

@dataclass
class Node:
    feature: int = -1
    cut: float = 0.0
    low: Node | None = None
    high: Node | None = None
    value: float = 0.0

    def sql(self) -> str:
        if self.feature < 0:
            return f"{self.value:.8f}D"
        return (f"CASE WHEN `{FEATURES[self.feature]}` <= {self.cut:g} THEN {self.low.sql()} "
                f"ELSE {self.high.sql()} END")

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(x), self.value)
        return np.where(x[:, self.feature] <= self.cut, self.low.predict(x), self.high.predict(x))


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int) -> Node:
    """A tree on weighted gradients ``g`` and curvatures ``h`` (second-order gain, L2 of 1)."""
    leaf = Node(value=float(-RATE * g.sum() / (h.sum() + 1.0)))
    if depth == 0:
        return leaf
    best, score = None, g.sum() ** 2 / (h.sum() + 1.0)
    for f in range(x.shape[1]):
        values, at = np.unique(x[:, f], return_inverse=True)
        gs, hs = np.cumsum(np.bincount(at, g)), np.cumsum(np.bincount(at, h))
        gain = gs ** 2 / (hs + 1) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + 1) - score
        gain[(hs < 1) | (hs[-1] - hs < 1)] = 0
        if len(values) > 1 and (best is None or gain[:-1].max() > best[0] + 1e-9):
            best = (float(gain[:-1].max()), f, float(values[int(gain[:-1].argmax())]))
    if best is None or best[0] <= 1e-6:
        return leaf
    low = x[:, best[1]] <= best[2]
    return Node(best[1], best[2], _grow(x[low], g[low], h[low], depth - 1), _grow(x[~low], g[~low], h[~low], depth - 1))


def boost(x: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> tuple[float, list[Node]]:
    """Gradient boosting of the logistic loss; row ``i`` stands for ``pos[i] + neg[i]`` examples."""
    bias = float(np.log((pos.sum() + 1) / (neg.sum() + 1)))
    score, trees = np.full(len(x), bias), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        tree = _grow(x, (pos + neg) * p - pos, (pos + neg) * p * (1 - p), DEPTH)
        trees.append(tree)
        score = score + tree.predict(x)
    return bias, trees


@dataclass
class Model:
    bias: float
    trees: list[Node]
    thresholds: dict[int, float]

    def score(self) -> Column:
        return F.expr(" + ".join([f"{self.bias:.8f}D", *(f"({t.sql()})" for t in self.trees)]))


def examples(found: DataFrame) -> DataFrame:
    """Counts per feature vector: ``pos, neg, luhn`` of the data (``luhn``: plausible but for Luhn's
    check) and ``prior_pos, prior_neg`` of the fixed examples. ``found`` has the columns ``_free``
    (touches no base span) and ``_open`` (touches no failed base match of its kind)."""
    spark = found.sparkSession
    own = ("kind", "wide", "value", "left", "right")
    glued = F.col("left").rlike(r"[\p{L}\p{N}]$") | F.col("right").rlike(r"^[\p{L}\p{N}]")
    digits = F.length(F.regexp_replace("value", "[^0-9]", ""))
    luhn = (F.col("kind") == 2) & (F.col("wide") == 1) & ~F.col("plausible") & ~glued & F.col("_open") & digits.between(14, 19)
    refuted = found.filter("start is not null").filter(F.when(F.col("wide") == 0, ~F.col("valid")).otherwise(
        F.col("_free") & (~F.col("plausible") | glued | ~F.col("_open"))))
    prior = spark.createDataFrame([(KINDS.index(k), 1, v, a, z, "prior_pos" if good else "prior_neg")
                                   for k, good, a, v, z in PRIOR],
                                  "kind int, wide int, value string, left string, right string, sort string")
    # A rewritten span that would not be plausible is no example of what may be added.
    rows = rewritten(found).filter((F.col("kind") != 3) | digits.between(10, 15)).select(*own, F.lit("pos").alias("sort")) \
        .unionByName(refuted.select(*own, F.when(luhn, "luhn").otherwise("neg").alias("sort"))).unionByName(prior)
    return with_features(rows).groupBy(*FEATURES).agg(
        *[F.count(F.when(F.col("sort") == c, 1)).alias(c) for c in ("pos", "neg", "luhn", "prior_pos", "prior_neg")])


def fit(found: DataFrame, precision: float = PRECISION) -> Model:
    """The trees and thresholds of candidates, see ``examples``."""
    rows = examples(found).collect()  # bounded by the product of the features' bins
    rows = sorted(rows, key=lambda r: tuple(r[f] for f in FEATURES))
    x = np.array([[float(r[f]) for f in FEATURES] for r in rows])
    pos, neg, luhn, prior_pos, prior_neg = (
        np.array([r[c] for r in rows], float) for c in ("pos", "neg", "luhn", "prior_pos", "prior_neg"))
    neg = neg + luhn / 9
    for kind in range(len(KINDS)):
        own = x[:, 0] == kind
        for seen, prior in ((pos, prior_pos), (neg, prior_neg)):
            prior[own] *= PRIOR_WEIGHT
            seen[own] *= min(1.0, prior[own].sum() / max(1.0, seen[own].sum()))
    pos, neg = pos + prior_pos, neg + prior_neg
    bias, trees = boost(x, pos, neg)
    score = bias + sum(t.predict(x) for t in trees)
    thresholds = {}
    for kind in range(len(KINDS)):
        # Only candidates of the further generators that are not glued are ever added.
        own = (x[:, 0] == kind) & (x[:, 1] == 1) & (x[:, FEATURES.index("before")] == 0) & (x[:, FEATURES.index("after")] == 0)
        order = np.argsort(-score[own], kind="stable")
        ranked = score[own][order]
        share = np.cumsum(pos[own][order]) / np.maximum(np.cumsum((pos + neg)[own][order]), 1e-9)
        last = np.append(ranked[1:] < ranked[:-1] - 1e-5, True)[:len(ranked)]     # vectors of one score go together
        good = np.flatnonzero((share >= precision) & last)
        if len(good):
            # Half-way to the next score, so vectors that no example has are not held to the best ones'
            # scores; the SQL expression carries eight decimals per tree.
            below = ranked[good[-1] + 1:]
            thresholds[kind] = float(ranked[good[-1]] + below[0]) / 2 if len(below) else float(ranked[-1]) - 1e-6
    return Model(bias, trees, thresholds)


def _named(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added``."""
    order = ("start", F.desc("_base"), "kind", "wide")
    earlier = Window.partitionBy("_row").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)

    def clear_of(spans: Column, *group: str) -> Column:
        w = Window.partitionBy("_row", *group).orderBy(*order)
        left = F.max(F.when(spans, F.col("end"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
        right = F.min(F.when(spans, F.col("start"))).over(w.rowsBetween(1, Window.unboundedFollowing))
        return F.coalesce(left <= F.col("start"), F.lit(True)) & F.coalesce(right >= F.col("end"), F.lit(True))

    base = F.coalesce((F.col("wide") == 0) & F.col("valid"), F.lit(False))
    found = staged(candidates(docs, id_col, text_col).withColumn("_base", base)
                   .withColumn("_free", clear_of(F.col("_base")))
                   .withColumn("_open", clear_of(F.col("failed"), "kind")), "candidates")
    model = fit(found)
    wanted = F.lit(False)
    for kind, least in model.thresholds.items():
        wanted = wanted | ((F.col("kind") == kind) & (model.score() >= least))
    # Only whole, plausible matches of the further generators are added, and none that touches a
    # base match of its kind that failed its check: such a match is not tried again.
    wanted = (F.col("wide") == 1) & F.col("_free") & F.col("_open") & F.col("plausible") & (F.col("before") == 0) & (F.col("after") == 0) & wanted
    marked = with_features(found).withColumn("_added", F.coalesce(wanted, F.lit(False)))
    left_end = F.max(F.when(F.col("_added"), F.col("end"))).over(earlier)
    kept = marked.withColumn("_kept", F.col("_base") | (
        F.col("_added") & F.coalesce(left_end <= F.col("start"), F.lit(True))))
    span = F.struct("start", "kind", "end")
    return kept.groupBy("_row", "_doc").agg(
        *[F.count(F.when(F.col("_base") & (F.col("kind") == i), 1)).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.collect_list(F.when(F.col("_base"), span)).alias("_b"),
        F.collect_list(F.when(F.col("_kept"), span)).alias("_s"),
        F.count(F.when(F.col("_kept") & ~F.col("_base"), 1)).alias("n_added")).select(
        F.col("_doc").alias("doc_id"), *[f"n_{k}" for k in KINDS],
        F.sha2(_named(F.col("_b")), 256).alias("base_sha256"), _named(F.col("_s")).alias("spans"), "n_added")


def redact(text: Column, spans: Column) -> Column:
    """``text`` with each span of a ``spans`` string replaced by its kind in brackets; a span that
    begins inside an earlier one goes with that."""
    parts = F.filter(F.transform(F.split(spans, ","), lambda s: F.split(s, ":")), lambda p: F.size(p) == 3)
    done = F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), lambda a, p: F.when(
        p[1].cast("int") < a["at"], F.struct(F.greatest(a["at"], p[2].cast("int")).alias("at"), a["out"].alias("out"))
    ).otherwise(F.struct(p[2].cast("int").alias("at"), F.concat(
        a["out"], F.substr(text, a["at"] + 1, p[1].cast("int") - a["at"]), F.lit("["), F.upper(p[0]),
        F.lit("]")).alias("out"))))
    return F.concat(done["out"], F.substr(text, done["at"] + 1))
