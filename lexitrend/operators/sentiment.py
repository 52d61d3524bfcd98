"""Comment sentiment and per-word monthly sentiment, as Spark jobs.

Lexicon scoring follows the published VADER rules (Hutto & Gilbert, ICWSM 2014): a lexicon
valence per token; boosters and negations among the three tokens before it; all-caps emphasis;
``but`` weighting; ``!``/``?`` emphasis; ``compound = s / sqrt(s^2 + 15)`` rounded to 4
places. The lexicon, boosters and negations are inputs (DataFrames), not bundled data.
Idiom phrases are applied when given. ``drop_single_chars`` leaves one-character tokens out
before distances are counted, as some published scorers do.

Plan shape, and why
-------------------
A comment is one row, and everything its score depends on is in that row or in the lists. Lists of at
most ``lexitrend.inline.maxBytes`` (1 MB) become one array of small maps, a constant
of the plan; for the facts and the words' sentiment, tokens are looked up there and scored by functions over
the comment's token list (:func:`with_compound`), so scoring shuffles nothing. The scored comments' words
are then exploded, looked up in the bank and added up per month.

Longer lists, idioms and :func:`lexicon_sentiment` look tokens up by a join instead. A comment then gets a row id of its own, so comment keys
may repeat or be NULL. Its whitespace tokens are exploded as ``(i, token, caps flag)`` and looked up once in one vocabulary
(lexicon, boosters, negations, the words the rules name, bank words). Only hits go on: tokens of
the vocabulary, tokens with ``n't``, and one marker per comment. They are shuffled by row id once,
and a window over a comment's hits in order of place gives each scored token the hits one to three
places before it and after it; a place that holds no hit cannot change a score. The valence sum
per comment then needs no further shuffle. No Python runs in the plan.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import tokens
from .broadcast import Dimension, broadcast_bounded, dimension, join_dimension
from .frequency import is_size, size_of, with_size

# Item kinds inside the per-comment stream.
KIND_DOC = 0      # one per comment, so comments without hits still get a score
KIND_SCORE = 1    # a whitespace token that may carry valence
KIND_BANK = 2     # a cleaned token that may be a bank word

_PUNCT = r"^\p{Punct}+|\p{Punct}+$"
_WHITE_SPACE = " \t\n\u000b\f\r"
_LINE_ENDS = ("\u0085", "\u2028", "\u2029")     # line terminators that are not white space
_OUTER = (*string.punctuation, *_LINE_ENDS)
SUM_DECIMALS = 10
# Words the rules name; they are hits whether or not the lists hold them.
RULE_WORDS = ("but", "never", "so", "this", "least", "at", "very", "without", "doubt", "kind", "of")
# Those that act on words after them by themselves.
ACTING_WORDS = ("never", "without", "least")

INLINE_BYTES_CONF = "lexitrend.inline.maxBytes"
DEFAULT_INLINE_BYTES = 1024 * 1024


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), 0)


def sentiment_tokens(body: Column, drop_single_chars: bool = False) -> Column:
    """Whitespace tokens of the raw body; outer ASCII punctuation is stripped unless that would
    leave two characters or fewer (so ``:)`` and ``:(`` stay whole)."""
    inner = F.btrim(body, F.lit(_WHITE_SPACE))
    raw = F.when(inner != "", F.split(inner, r"\s+")).when(inner == "", F.array().cast("array<string>"))

    def strip(t: Column) -> Column:
        # To the pattern, a token ends before a last line terminator too; trimming knows no such rule.
        ends_line = _any(t.endswith(c) for c in _LINE_ENDS)
        return F.when(ends_line, F.regexp_replace(t, _PUNCT, "")).otherwise(F.btrim(t, F.lit(string.punctuation)))

    def token(t: Column) -> Column:
        # Most tokens have nothing to strip, which their first and last characters tell.
        whole = (F.length(t) <= 2) | ~(F.substring(t, 1, 1).isin(*_OUTER) | F.substring(t, -1, 1).isin(*_OUTER))
        return F.when(whole, t).otherwise(_once(strip(t), lambda s: F.when(F.length(s) <= 2, t).otherwise(s)))

    stripped = F.transform(raw, token)
    return F.filter(stripped, lambda t: F.length(t) > 1) if drop_single_chars else stripped


def _is_upper(t: Column, low: Column) -> Column:
    """Python ``str.isupper`` of ``t``, in lower case ``low``: has a cased character and no lower-case one."""
    return (low != t) & (F.upper(t) == t)


def punctuation_emphasis(body: Column) -> Column:
    """``!`` adds 0.292 each, at most 4; two or three ``?`` add 0.18 each, more add 0.96."""
    n_excl = F.length(body) - F.length(F.replace(body, F.lit("!"), F.lit("")))
    n_q = F.length(body) - F.length(F.replace(body, F.lit("?"), F.lit("")))
    excl = F.least(n_excl, F.lit(C.EXCLAMATION_MAX)) * C.EXCLAMATION_WEIGHT
    quest = (F.when(n_q <= 1, F.lit(0.0))
             .when(n_q <= 3, n_q * C.QUESTION_WEIGHT)
             .otherwise(F.lit(C.QUESTION_MAX_WEIGHT)))
    return F.coalesce(excl + quest, F.lit(0.0))


def vocabulary(lexicon: DataFrame, boosters: DataFrame | None = None,
               negations: DataFrame | None = None, bank: DataFrame | Dimension | None = None,
               rule_words: tuple[str, ...] = RULE_WORDS, phrases: DataFrame | None = None) -> DataFrame:
    """One lookup table keyed by lower-case ``word``: ``valence`` (lexicon), ``booster`` (scalar),
    ``negate``, ``scored`` (any role in scoring; words of ``phrases`` have one) and ``in_bank`` flags. Duplicate lexicon or
    booster entries keep the largest value. Words are put together by one aggregate."""
    spark = lexicon.sparkSession

    def role(df: DataFrame, valence="null", booster="null", negate="false", scored="true", in_bank="false") -> DataFrame:
        return df.select("word", *[F.expr(x).cast(t).alias(n) for x, t, n in (
            (valence, "double", "valence"), (booster, "double", "booster"), (negate, "boolean", "negate"),
            (scored, "boolean", "scored"), (in_bank, "boolean", "in_bank"))])

    rows = role(lexicon.withColumn("word", F.lower("word")), valence="valence")
    rows = rows.unionByName(role(spark.createDataFrame([(w,) for w in rule_words], "word string")))
    if phrases is not None:
        rows = rows.unionByName(role(phrases.select(F.explode(F.split("phrase", " ")).alias("word"))))
    if boosters is not None:
        rows = rows.unionByName(role(boosters.withColumn("word", F.lower("word")), booster="scalar"))
    if negations is not None:
        rows = rows.unionByName(role(negations.withColumn("word", F.lower("word")), negate="true"))
    if bank is not None:
        bank = bank.df if isinstance(bank, Dimension) else bank
        rows = rows.unionByName(role(bank, scored="false", in_bank="true"))
    return rows.filter("word is not null").groupBy("word").agg(
        F.max("valence").alias("valence"), F.max("booster").alias("booster"), F.max("negate").alias("negate"),
        F.max("scored").alias("scored"), F.max("in_bank").alias("in_bank"))


def _hits(comments: DataFrame, vocab: DataFrame | Dimension, key: str, body: str, with_bank: bool,
          drop_single_chars: bool) -> DataFrame:
    """``_rid, kind, i, w, u`` and vocabulary columns of the hits; the marker row of a comment
    (kind 0) carries ``meta`` (key, month, emphasis), score rows carry ``cap_diff``."""
    b = F.col(body)
    empty = F.array().cast("array<string>")
    docs = comments.select(
        F.monotonically_increasing_id().alias("_rid"), F.col(key).alias("_key"), "year_month",
        punctuation_emphasis(b).alias("_amp"),
        F.coalesce(sentiment_tokens(b, drop_single_chars), empty).alias("_toks"),
        (F.coalesce(tokens(b), empty) if with_bank else empty).alias("_bank"))
    docs = docs.select("_rid", F.struct(F.col("_key").alias("key"), "year_month", F.col("_amp").alias("amp"),
                                        F.size("_bank").cast("long").alias("n_tokens")).alias("_meta"), "_bank",
                       "_toks", F.transform("_toks", F.lower).alias("_low"))
    docs = docs.withColumn("_up", F.zip_with("_toks", "_low", _is_upper)).drop("_toks")
    # The marker's word holds its row id: it matches nothing and has a join key of its own.
    marker = F.array(F.concat(F.lit("\u0000"), F.col("_rid").cast("string")))
    docs = docs.withColumns({"_cap": F.array_contains("_up", True) & F.array_contains("_up", False), "_n": F.size("_low")})
    i = F.col("i")
    rows = docs.select("_rid", "_meta", "_cap", "_n", "_up", F.posexplode(F.concat(marker, "_low", "_bank")).alias("i", "word")).select(
        "_rid", F.when(i == 0, KIND_DOC).when(i <= F.col("_n"), KIND_SCORE).otherwise(KIND_BANK).alias("kind"), "i", "word",
        F.get("_up", i - 1).alias("u"), F.col("_cap").alias("cap_diff"), F.when(i == 0, F.col("_meta")).alias("meta"))
    # Other rows matter only when the vocabulary holds their word.
    found = join_dimension(rows, vocab, "word", "left", wanted=(F.col("kind") == KIND_DOC) | (
        (F.col("kind") == KIND_SCORE) & F.col("word").contains("n't")))
    scored = (F.col("kind") == KIND_SCORE) & (F.coalesce("scored", F.lit(False)) | F.col("word").contains("n't"))
    in_bank = (F.col("kind") == KIND_BANK) & F.coalesce("in_bank", F.lit(False))
    return found.filter((F.col("kind") == KIND_DOC) | scored | in_bank)


def _gathered(hits: DataFrame) -> DataFrame:
    """The hits of each comment gathered in one row before they are shuffled, and dealt out again without
    its bank words, which no score depends on: the marker row carries these in ``meta.matched``."""
    scored = F.struct("i", "kind", "word", "u", "cap_diff", "valence", "booster", "negate")
    bank = F.col("kind") == KIND_BANK
    rows = hits.groupBy("_rid").agg(
        F.collect_list(F.when(~bank, scored)).alias("_scored"), F.collect_list(F.when(bank, F.col("word"))).alias("_matched"),
        F.max("meta").alias("_meta"))
    rows = rows.select("_rid", F.explode("_scored").alias("_x"), "_meta", "_matched").select("_rid", "_x.*", "_meta", "_matched")
    return rows.select(*rows.columns[:-2], F.when(F.col("kind") == KIND_DOC, F.struct(
        "_meta.*", F.col("_matched").alias("matched"))).alias("meta"))


def _with_context(hits: DataFrame) -> DataFrame:
    """Add, to every hit, its place from 0 and the hits up to three places before and two after."""
    order = Window.partitionBy("_rid").orderBy("i")
    own = F.struct(
        F.col("i"), F.col("word").alias("w"), F.col("u"), F.col("valence").isNotNull().alias("lex"),
        F.col("booster").alias("boost"),
        (F.coalesce("negate", F.lit(False)) | F.col("word").contains("n't")).alias("neg"))
    hits = hits.withColumn("_own", F.when(F.col("kind") == KIND_SCORE, own))
    near = {**{f"_l{k}": F.lag("_own", k).over(order) for k in (1, 2, 3)},
            **{f"_r{k}": F.lead("_own", k).over(order) for k in (1, 2)}}
    # The same order as above, so that one window operator gives both.
    but = F.min(F.when((F.col("kind") == KIND_SCORE) & (F.col("word") == "but"), F.col("i"))).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    hits = hits.withColumns({**near, "but_at": but})

    def at(d: int) -> Column:
        side = "_l" if d > 0 else "_r"
        return F.coalesce(*[F.when(F.col(f"{side}{k}.i") == F.col("i") - d, F.col(f"{side}{k}"))
                            for k in range(1, abs(d) + 1)])

    for d, name in ((1, "c1"), (2, "c2"), (3, "c3"), (-1, "n1"), (-2, "n2")):
        hits = hits.withColumn(name, at(d))
    for d in (1, 2, 3):
        c = f"c{d}"
        hits = hits.withColumns({
            f"w{d}": F.coalesce(f"{c}.w", F.lit("")), f"u{d}": F.coalesce(f"{c}.u", F.lit(False)),
            f"lex{d}": F.coalesce(f"{c}.lex", F.lit(False)), f"boost{d}": F.col(f"{c}.boost"),
            f"neg{d}": F.coalesce(f"{c}.neg", F.lit(False))})
    return hits.withColumns({"wn": F.coalesce("n1.w", F.lit("")), "wnn": F.coalesce("n2.w", F.lit(""))})


def _idiom_valence(df: DataFrame, idioms: Dimension, applies: Column) -> DataFrame:
    """``df`` with the valence ``v`` of a token inside an idiom replaced: by that of a phrase that
    begins at the token, else of one that ends at it or one place before it. Each of the seven places a
    phrase can lie is one look-up of its words in the phrase table, by a measured broadcast or a
    salted join; nothing of the table is in the plan, so its length does not matter."""
    w0, w1, w2, w3, n1, n2 = (F.col(c) for c in ("word", "w1", "w2", "w3", "wn", "wnn"))
    phrases = ((w0, n1, n2), (w0, n1), (w1, w0), (w2, w1, w0), (w2, w1), (w3, w2, w1), (w3, w2))
    columns = df.columns
    found = [f"_idiom{k}" for k in range(len(phrases))]
    for name, words in zip(found, phrases):
        phrase = F.when(applies & F.col("v").isNotNull(), F.concat_ws(" ", *words))
        df = join_dimension(df.withColumn("phrase", phrase), Dimension(
            idioms.df.withColumnRenamed("idiom_valence", name), idioms.size), "phrase", "left").drop("phrase")
    return df.withColumn("v", F.coalesce(*found, "v")).select(*columns)


def _valence(df: DataFrame, idioms: Dimension | None) -> DataFrame:
    """Valence of each scored token after caps, boosters, negation, idioms, ``least`` and ``but``."""
    v, i = F.col("v"), F.col("i") - 1
    cap = F.col("cap_diff")
    kind_of = (F.col("word") == "kind") & (F.col("wn") == "of")
    is_scored = (F.col("kind") == KIND_SCORE) & F.col("valence").isNotNull() & F.col("booster").isNull() & ~kind_of
    df = df.withColumn("v", F.when(is_scored, F.col("valence")))
    df = df.withColumn("v", F.when(F.col("u") & cap, F.when(v > 0, v + C.CAPS_INCREMENT).otherwise(
        v - C.CAPS_INCREMENT)).otherwise(v))
    for d in (1, 2, 3):
        boost, neg = F.col(f"boost{d}"), F.col(f"neg{d}")
        applies = (i >= d) & ~F.col(f"lex{d}")
        s = F.when(v < 0, -boost).otherwise(boost)
        s = F.when(F.col(f"u{d}") & cap, F.when(v > 0, s + C.CAPS_INCREMENT).otherwise(s - C.CAPS_INCREMENT)).otherwise(s)
        s = F.coalesce(s * C.DISTANCE_DAMPING[d - 1], F.lit(0.0))
        df = df.withColumn("v", F.when(applies, v + s).otherwise(v))
        flip = neg
        if d > 1:
            inner = [F.col(f"w{k}") for k in range(1, d)]
            never_so = (F.col(f"w{d}") == "never") & _any(w.isin("so", "this") for w in inner)
            without_doubt = (F.col(f"w{d}") == "without") & _any(w == "doubt" for w in inner)
            df = df.withColumn("v", F.when(applies & never_so, v * C.NEVER_SO_SCALAR).otherwise(v))
            flip = ~never_so & ~without_doubt & neg
        df = df.withColumn("v", F.when(applies & flip, v * C.NEGATION_SCALAR).otherwise(v))
        if d == 3 and idioms is not None:
            df = _idiom_valence(df, idioms, applies)
    least = (F.col("w1") == "least") & ~F.col("lex1")
    least_flip = least & ((i == 1) | ((i > 1) & ~F.col("w2").isin("at", "very")))
    df = df.withColumn("v", F.when(least_flip, v * C.NEGATION_SCALAR).otherwise(v))
    but = F.col("but_at")
    factor = (F.when(F.col("i") < but, F.lit(C.BUT_BEFORE)).when(F.col("i") > but, F.lit(C.BUT_AFTER))
              .otherwise(F.lit(1.0)))
    return df.withColumn("sv", v * factor)


def _any(conditions) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def compound(sum_valence: Column, emphasis: Column) -> Column:
    """``s / sqrt(s^2 + 15)`` after adding emphasis away from zero; clipped; 4 decimals."""
    s = F.coalesce(sum_valence, F.lit(0.0))
    s = F.when(s > 0, s + emphasis).when(s < 0, s - emphasis).otherwise(s)
    norm = s / F.sqrt(s * s + C.NORMALIZE_ALPHA)
    return F.round(F.greatest(F.least(norm, F.lit(1.0)), F.lit(-1.0)), C.COMPOUND_DECIMALS)


def _per_comment(comments: DataFrame, vocab: DataFrame | Dimension, key: str, body: str, with_bank: bool,
                 idioms: Dimension | None = None, drop_single_chars: bool = False) -> DataFrame:
    hits = _with_context(_gathered(_hits(comments, vocab, key, body, with_bank, drop_single_chars)))
    # Hits that carry no valence have done their part in the context of others.
    scored = _valence(hits.filter("kind = 0 or valence is not null"), idioms)
    # The valence sum is rounded before its sign is tested: float addition order differs from
    # task to task, and an exact-zero sum must not turn into +/-1e-16 and gain the emphasis.
    aggs = [F.round(F.sum("sv"), SUM_DECIMALS).alias("_s"), F.max("meta").alias("_meta")]
    per_row = scored.groupBy("_rid").agg(*aggs)
    return per_row.select(F.col("_meta.key").alias(key), "_meta.year_month",
                          compound(F.col("_s"), F.col("_meta.amp")).alias("compound"),
                          *(["_meta.matched", F.col("_meta.n_tokens").alias("n_tokens")] if with_bank else []))


def inline_table(df: DataFrame, on: str) -> tuple[Column, Callable[[Column, Column], Column]]:
    """A small table as one value (an array of lists of rows, the keys dealt to them by hash), and a function of
    that value and a key that gives the key's other columns as a struct, or NULL. Spark takes two constants
    with equal lists for equal, but not with equal maps: a step with a map in it would run once per use."""
    slots = 1 << (8 * df.count()).bit_length()   # a key that is not there mostly finds an empty slot

    def slot(key: Column) -> Column:
        return F.hash(key).bitwiseAND(F.lit(slots - 1))

    entry = F.struct(on, F.struct(*[c for c in df.columns if c != on]).alias("_entry"))
    dealt = df.groupBy(slot(F.col(on)).alias("_at")).agg(F.collect_list(entry).alias("_rows"))
    every = df.sparkSession.range(slots).select(F.col("id").cast("int").alias("_at")).join(F.broadcast(dealt), "_at", "left")
    table = every.agg(F.transform(F.sort_array(F.collect_list(F.struct("_at", "_rows"))),
                                  lambda r: r["_rows"]).alias("_t"))
    # As text the table is a constant of the plan, which Spark reads once, before any row.
    value = F.from_json(F.lit(table.select(F.to_json("_t")).first()[0]), table.schema["_t"].dataType)
    return value, lambda value, key: F.get(F.filter(F.get(value, slot(key)), lambda r: r[on] == key), 0)["_entry"]


def _token_score(i: Column, low: Column, up: Column, e: Column, doc: Column) -> Column:
    """What the token at place ``i`` (from 0) adds to the sum, by the rules of :func:`_valence`; NULL if it
    carries no valence. ``e`` holds the vocabulary entries of the tokens ``low``, ``up`` whether those with an
    entry are in capitals, ``doc`` what the comment as a whole has (``caps``, ``but_at``)."""
    def at(d: int) -> Column:
        return F.get(e, i - d)

    def word(d: int) -> Column:
        return F.when(at(d).isNotNull(), F.get(low, i - d)).otherwise("")

    def context(d: int) -> Column:
        factor = F.when(at(d)["negate"], C.NEGATION_SCALAR)
        if d > 1:
            never_so = (word(d) == "never") & _any(word(k).isin("so", "this") for k in range(1, d))
            without_doubt = (word(d) == "without") & _any(word(k) == "doubt" for k in range(1, d))
            factor = F.when(never_so, C.NEVER_SO_SCALAR).when(without_doubt, 1.0).when(at(d)["negate"], C.NEGATION_SCALAR)
        # Nothing where the token does not act (one that carries valence never does).
        return F.when(at(d)["acts"], F.struct(
            at(d)["booster"].alias("boost"), (doc["caps"] & F.coalesce(F.get(up, i - d), F.lit(False))).alias("loud"),
            F.lit(C.DISTANCE_DAMPING[d - 1]).alias("damping"), factor.otherwise(1.0).alias("factor")))

    def louder(loud: Column, sign: Column, x: Column) -> Column:
        return F.when(loud, F.when(sign > 0, x + C.CAPS_INCREMENT).otherwise(x - C.CAPS_INCREMENT)).otherwise(x)

    def step(v: Column, c: Column) -> Column:
        s = louder(c["loud"], v, F.when(v < 0, -c["boost"]).otherwise(c["boost"]))
        return F.when(c.isNull(), v).otherwise((v + F.coalesce(s * c["damping"], F.lit(0.0))) * c["factor"])

    own = at(0)["valence"]
    acted_on = _any(F.coalesce(at(d)["acts"], F.lit(False)) for d in (1, 2, 3))
    v = louder(doc["caps"] & F.get(up, i), own, own)
    v = F.when(acted_on, F.aggregate(F.array(*[context(d) for d in (1, 2, 3)]), v, step)).otherwise(v)
    least = at(1)["acts"] & (word(1) == "least") & ((i == 1) | ~word(2).isin("at", "very"))
    v = v * F.when(least, C.NEGATION_SCALAR).otherwise(1.0)
    v = v * F.when(doc["but_at"].isNull(), 1.0).when(i + 1 < doc["but_at"], C.BUT_BEFORE).when(
        i + 1 > doc["but_at"], C.BUT_AFTER).otherwise(1.0)
    kind_of = (F.get(low, i) == "kind") & (word(-1) == "of")
    return F.when(own.isNotNull() & at(0)["booster"].isNull() & ~kind_of, v)


def with_compound(comments: DataFrame, body: str, vocab: DataFrame, drop_single_chars: bool = False) -> DataFrame:
    """``comments`` with the ``compound`` score of each body, computed in the row: the vocabulary comes along
    as an inline table."""
    acts = F.expr("valence is null") & (F.expr("booster is not null or negate") | F.col("word").isin(*ACTING_WORDS))
    words, find = inline_table(vocab.filter("scored").select("word", "valence", "booster", F.coalesce(
        "negate", F.lit(False)).alias("negate"), F.coalesce(acts, F.lit(False)).alias("acts")), "word")

    def negating(table: Column, w: Column) -> Column:
        # A token with n't negates, whatever the vocabulary has on it.
        return F.when(w.contains("n't"), _once(find(table, w), lambda x: F.struct(
            x["valence"].alias("valence"), x["booster"].alias("booster"), F.lit(True).alias("negate"),
            x["valence"].isNull().alias("acts")))).otherwise(find(table, w))

    def entries(table: Column, low: Column) -> Column:
        return F.when(F.lower(F.col(body)).contains("n't"), F.transform(low, lambda w: negating(table, w))).otherwise(
            F.transform(low, lambda w: find(table, w)))

    def total(low: Column, up: Column, e: Column, doc: Column) -> Column:
        scores = F.transform(e, lambda x, i: F.when(x["valence"].isNotNull(), _token_score(i, low, up, e, doc)))
        return F.aggregate(scores, F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))

    def of_comment(t: Column, low: Column, e: Column, up: Column) -> Column:
        # Capitals act on tokens with an entry only; the others are looked at if there is such a token.
        caps = F.array_contains(up, True) & F.exists(t, lambda x: ~_is_upper(x, F.lower(x)))
        but_at = F.nullif(F.array_position(low, "but").cast("int"), F.lit(0))
        return _once(F.struct(caps.alias("caps"), but_at.alias("but_at")), lambda doc: total(low, up, e, doc))

    toks = F.coalesce(sentiment_tokens(F.col(body), drop_single_chars), F.array().cast("array<string>"))
    summed = _once(words, lambda table: _once(toks, lambda t: _once(F.transform(t, F.lower), lambda low: _once(
        entries(table, low), lambda e: _once(F.zip_with(t, e, lambda x, y: y.isNotNull() & _is_upper(x, F.lower(x))),
                                             lambda up: of_comment(t, low, e, up))))))
    score = _once(F.struct(F.round(summed, SUM_DECIMALS).alias("s"), punctuation_emphasis(F.col(body)).alias("amp")),
                  lambda x: compound(x["s"], x["amp"]))
    return comments.select(*comments.columns, score.alias("compound"))


def _inline(comments: DataFrame, vocab: Dimension, idioms: Dimension | None) -> bool:
    """Whether the vocabulary is short enough to be looked up inside a comment's row, and there are no idioms."""
    return idioms is None and vocab.size <= int(
        comments.sparkSession.conf.get(INLINE_BYTES_CONF, str(DEFAULT_INLINE_BYTES)))


def _scored_comments(comments: DataFrame, vocab: Dimension, body: str, drop_single_chars: bool) -> DataFrame:
    """``year_month``, body and ``compound`` of each comment, for a vocabulary that is looked up inside the row."""
    return with_compound(comments.select("year_month", body), body, vocab.df, drop_single_chars)


def _bank_words(bank: DataFrame | Dimension) -> Dimension:
    """The words of a bank once each, flagged ``_hit``."""
    bank = dimension(bank)
    return Dimension(bank.df.select("word").filter("word is not null").distinct().withColumn("_hit", F.lit(True)), bank.size)


def idiom_table(idioms: DataFrame | None) -> Dimension | None:
    """``(phrase, idiom_valence)`` of an idiom list (columns ``phrase, valence``; lower case, the
    largest valence of a phrase given twice), materialized and measured; None without idioms."""
    if idioms is None:
        return None
    rows = idioms.select(F.lower("phrase").alias("phrase"), F.col("valence").cast("double").alias("v")).filter(
        "phrase != '' and v is not null")
    found = dimension(rows.groupBy("phrase").agg(F.max("v").alias("idiom_valence")))
    return None if found.df.isEmpty() else found


def _scoring_vocabulary(lexicon, boosters, negations, bank, phrases: Dimension | None) -> Dimension:
    return dimension(vocabulary(lexicon, boosters, negations, bank, phrases=None if phrases is None else phrases.df))


def lexicon_sentiment(comments: DataFrame, lexicon: DataFrame, boosters: DataFrame | None = None,
                      negations: DataFrame | None = None, key: str = "doc_id", body: str = "body",
                      idioms: DataFrame | None = None, drop_single_chars: bool = False) -> DataFrame:
    """``(doc_id, year_month, compound)``, one row per comment row; no lexicon word gives 0.0."""
    phrases = idiom_table(idioms)
    vocab = _scoring_vocabulary(lexicon, boosters, negations, None, phrases)
    return _per_comment(comments, vocab, key, body, False, phrases, drop_single_chars)


def sample_fraction_key(key: Column, seed: int) -> Column:
    """A repeatable uniform number in [0, 1) per key: the first 8 hex digits of
    ``md5(key || '|' || seed)`` over 16^8. Re-running a task gives the same sample."""
    h = F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long") / float(16 ** 8)


def sample_to_target(comments: DataFrame, target: int, seed: int = 0, key: str = "doc_id") -> DataFrame:
    """Down-sample each month to about ``target`` comments, without replacement.

    Month sizes come from one ``groupBy(year_month).count()`` (one row per month, so the
    broadcast is bounded by the calendar); each row is kept when its hash draw is below
    ``target / month size``. Months at or under the target are kept whole; an empty month simply
    has no rows, so nothing divides by zero. Rows without a key draw by their other columns.
    """
    sizes = comments.groupBy("year_month").agg(F.count(F.lit(1)).alias("_n"))
    frac = F.lit(float(target)) / F.col("_n")
    draw = F.coalesce(F.col(key).cast("string"), F.xxhash64(*[F.col(c) for c in comments.columns]).cast("string"))
    return (comments.join(broadcast_bounded(sizes), "year_month")
            .filter((frac >= 1.0) | (sample_fraction_key(draw, seed) < frac))
            .drop("_n"))


def score_units(score: Column) -> Column:
    """A score as a whole number of ten-thousandths (scores have four decimals)."""
    return F.round(score * 10 ** C.COMPOUND_DECIMALS).cast("long")


def moments(units: Column) -> list[Column]:
    """Aggregates ``n, s1, s2``: number, sum and sum of squares of whole-number scores. They are
    integers, so they are the same in whatever order rows are added, and two of them merge by adding.
    (64 bits hold 9e10 observations of a word in a month; beyond that Spark raises an error.)"""
    return [F.count(units).alias("n"), F.sum(units).alias("s1"), F.sum(units * units).alias("s2")]


def merged(rows: DataFrame, *keys: str) -> DataFrame:
    """Moments of the union of disjoint sets of observations."""
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n", "s1", "s2")])


def average(n: str = "n", s1: str = "s1") -> Column:
    return F.col(s1) / (F.col(n) * float(10 ** C.COMPOUND_DECIMALS))


def deviation(n: str = "n", s1: str = "s1", s2: str = "s2") -> Column:
    """Sample deviation (NULL for one observation), from an exact numerator ``n s2 - s1 s1``."""
    a, b, c = (F.col(x).cast("decimal(19,0)") for x in (n, s1, s2))
    return F.when(F.col(n) > 1, F.sqrt((a * c - b * b).cast("double") / (
        F.col(n).cast("double") * (F.col(n) - 1).cast("double"))) / float(10 ** C.COMPOUND_DECIMALS))


def from_moments(rows: DataFrame) -> DataFrame:
    """``(year_month, word, avg_sentiment, stddev_sentiment)`` of moments by month and word."""
    return rows.select("year_month", "word", average().alias("avg_sentiment"), deviation().alias("stddev_sentiment"))


def monthly_word_moments(
    comments: DataFrame,
    bank: DataFrame | Dimension,
    lexicon: DataFrame | None = None,
    boosters: DataFrame | None = None,
    negations: DataFrame | None = None,
    *,
    target: int | None = None,
    seed: int = 0,
    key: str = "doc_id",
    body: str = "body",
    scorer: Callable[[Column], Column] | None = None,
    idioms: DataFrame | None = None,
    drop_single_chars: bool = False,
) -> DataFrame:
    """``(year_month, word, n, s1, s2)``: the mergeable moments of the scores of the comments that
    use a bank word. A word used k times in a comment adds that comment's score k times.

    Every comment counts unless ``target`` is given, which samples each month first (see
    :func:`sample_to_target`). ``scorer`` replaces the
    lexicon with any ``Column -> Column`` scorer of the body (for example a user ``pandas_udf``);
    its scores are taken to four decimals, computed in-row, and no per-comment shuffle is needed.
    """
    if target is not None:
        comments = sample_to_target(comments, target, seed, key)
    if scorer is not None:
        scored = comments.select("year_month", scorer(F.col(body)).alias("compound"),
                                 F.explode(tokens(body)).alias("word"))
        rows = join_dimension(scored, bank, "word", "left_semi")
    else:
        if lexicon is None:
            raise ValueError("a lexicon or a scorer is required")
        phrases = idiom_table(idioms)
        vocab = _scoring_vocabulary(lexicon, boosters, negations, None, phrases)
        if _inline(comments, vocab, phrases):
            scored = _scored_comments(comments, vocab, body, drop_single_chars)
            rows = join_dimension(scored.select("year_month", "compound", F.explode(tokens(body)).alias("word")),
                                  bank, "word", "left_semi")
        else:
            vocab = _scoring_vocabulary(lexicon, boosters, negations, bank, phrases)
            per_doc = _per_comment(comments, vocab, key, body, True, phrases, drop_single_chars)
            rows = per_doc.filter(F.size("matched") > 0).select(
                "year_month", "compound", F.explode("matched").alias("word"))
    return rows.groupBy("year_month", "word").agg(*moments(score_units(F.col("compound"))))


def monthly_word_sentiment(comments: DataFrame, bank: DataFrame | Dimension, *args, **options) -> DataFrame:
    """``(year_month, word, avg_sentiment, stddev_sentiment)`` over the comments that use a bank
    word, from :func:`monthly_word_moments` (same arguments), so results are the same bit for bit
    at any partitioning. ``stddev`` is the sample deviation (NULL for a single observation)."""
    return from_moments(monthly_word_moments(comments, bank, *args, **options))


def _word_rows(scored: DataFrame, bank: DataFrame | Dimension, body: str) -> DataFrame:
    """``year_month, _x, word, _tokens`` of the tokens of scored comments: each bank word with its comment's
    score, and rows with a NULL word and no score. The sum of ``_tokens`` is the number of all tokens."""
    bank = _bank_words(bank)
    hit = F.coalesce("_hit", F.lit(False))
    # A token outside the bank would be moved or looked up in the aggregate to be counted; a comment's
    # number of tokens is one entry.
    rows = scored.select("year_month", "_x", F.explode(with_size(tokens(body))).alias("word"))
    rows = join_dimension(rows, bank, "word", "left", wanted=is_size(F.col("word"))).filter(hit | is_size(F.col("word")))
    count = F.when(hit, 0).otherwise(size_of(F.col("word")))
    return rows.select("year_month", F.when(hit, F.col("_x")).alias("_x"), F.when(hit, F.col("word")).alias("word"),
                       count.alias("_tokens"))


def monthly_word_facts(comments: DataFrame, bank: DataFrame | Dimension, lexicon: DataFrame,
                       boosters: DataFrame | None = None, negations: DataFrame | None = None, *,
                       key: str = "doc_id", body: str = "body", idioms: DataFrame | None = None,
                       drop_single_chars: bool = False) -> DataFrame:
    """``(year_month, word, count, frequency, avg_sentiment, stddev_sentiment)`` of the bank words
    in one pass: the counts, frequencies and sentiment that ``monthly_ngrams_of`` and
    ``monthly_word_sentiment`` give. Tokens outside the bank are counted under a NULL word, so month
    totals (every token counts) come out of the same aggregate; they are joined back by broadcast
    (one row per month)."""
    phrases = idiom_table(idioms)
    vocab = _scoring_vocabulary(lexicon, boosters, negations, None, phrases)
    if _inline(comments, vocab, phrases):
        scored = _scored_comments(comments, vocab, body, drop_single_chars).select(
            "year_month", score_units(F.col("compound")).alias("_x"), body)
        rows = _word_rows(scored, bank, body)
    else:
        vocab = _scoring_vocabulary(lexicon, boosters, negations, bank, phrases)
        per_row = _per_comment(comments, vocab, key, body, True, phrases, drop_single_chars)
        rows = per_row.select("year_month", score_units(F.col("compound")).alias("_x"), "n_tokens", F.explode(
            F.concat("matched", F.array(F.lit(None).cast("string")))).alias("word")).withColumn(
            "_tokens", F.when(F.col("word").isNull(), F.col("n_tokens")).otherwise(0))
    # Facts and totals share this aggregate only if both read all its columns and filter on what it gives:
    # a filter on the word would reach the comments, and they would be scored once for each.
    agg = rows.groupBy("year_month", "word").agg(
        *moments(F.col("_x")), F.sum("_tokens").alias("_tokens"), F.max(F.col("word").isNull()).alias("_is_total"))
    agg = agg.filter("n >= 0 or s1 is not null or s2 is not null or _tokens is not null or _is_total")  # always true
    totals = broadcast_bounded(agg.groupBy("year_month").agg(F.sum("_tokens").alias("_total")))
    return agg.filter("not _is_total").join(totals, "year_month").select(
        "year_month", "word", F.col("n").alias("count"), F.try_divide(F.col("n"), F.col("_total")).alias("frequency"),
        average().alias("avg_sentiment"), deviation().alias("stddev_sentiment"))
