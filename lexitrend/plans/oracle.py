"""DuckDB SQL for every registered query, over the driver's Parquet views.

Each statement rebuilds its inputs from the raw tables with the same fixture rules, using
SQL's own means (window ``lag`` over token positions for sentiment, ``row_number`` for the best
definition, a cross product for the calendar grid), so the comparison checks the Spark plans
against an independent formulation.
"""

from __future__ import annotations

from ..constants import (
    BAD_WORD_EXTRAS, BUT_AFTER, BUT_BEFORE, CAPS_INCREMENT, DISTANCE_DAMPING,
    EXCLAMATION_MAX, EXCLAMATION_WEIGHT, NEGATION_SCALAR, NEVER_SO_SCALAR, NORMALIZE_ALPHA,
    QUESTION_MAX_WEIGHT, QUESTION_WEIGHT, RANK_DIGITS, SENTIMENT_DECIMALS,
)
from ..sources import testdata as TD
from . import catalog as Q

R = Q.ROUND
TOK = r"regexp_split_to_array(regexp_replace(lower({x}), '[^\w\s]', '', 'g'), '\s+')"
STRIP = r"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def tok(x: str) -> str:
    return TOK.format(x=x)


def strip(x: str) -> str:
    return STRIP.format(x=x)


# name -> (dependencies, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body)


cte("comments", (), """
    SELECT d.doc_id, d.source AS subreddit, d.text AS body,
           CAST(date_trunc('month', o.o_orderdate) AS DATE) AS year_month
    FROM documents d JOIN orders o ON d.doc_id = o.o_orderkey""")
cte("stop", (), "SELECT word FROM " + TD.sql_values(TD.FIXTURE_STOPWORDS, "word"))
cte("lex", (), "SELECT lower(word) AS word, max(valence) AS valence FROM "
    + TD.sql_values(TD.FIXTURE_LEXICON, "word, valence") + " GROUP BY 1")
cte("boo", (), "SELECT lower(word) AS word, max(scalar) AS scalar FROM "
    + TD.sql_values(TD.FIXTURE_BOOSTERS, "word, scalar") + " GROUP BY 1")
cte("neg", (), "SELECT DISTINCT lower(word) AS word FROM " + TD.sql_values(TD.FIXTURE_NEGATIONS, "word"))
cte("bad", (), "SELECT DISTINCT lower(" + strip("word") + ") AS word FROM "
    + TD.sql_values(TD.FIXTURE_BAD_WORDS + BAD_WORD_EXTRAS, "word"))
cte("bank_src", (), f"SELECT DISTINCT unnest({tok('text')}) AS word FROM benchmark")
cte("bank", ("bank_src", "stop"), """
    SELECT DISTINCT lower(word) AS word FROM bank_src
    WHERE len(string_split(word, ' ')) = 1
      AND lower(word) NOT IN (SELECT lower(word) FROM stop)""")
cte("dict", (), """
    SELECT regexp_extract(text, '^[^.,]+', 0) AS word, text AS definition,
           CAST(length(text) AS BIGINT) AS up_votes FROM conversations""")
cte("defs", ("dict",), f"""
    SELECT word, definition FROM (
      SELECT lower({strip('word')}) AS word, definition,
             row_number() OVER (PARTITION BY lower({strip('word')})
               ORDER BY up_votes IS NULL, up_votes DESC, definition IS NULL, definition) AS rn
      FROM dict
      WHERE len(regexp_split_to_array({strip('word')}, '\\s+')) = 1 AND {strip('word')} <> '')
    WHERE rn = 1""")
cte("toks", ("comments",), f"""
    SELECT doc_id, year_month, unnest({tok('body')}) AS word FROM comments""")
cte("counts", ("toks",), """
    SELECT year_month, word, count(*) AS count FROM toks GROUP BY year_month, word""")
cte("freq", ("counts",), """
    SELECT c.year_month, c.word, c.count, c.count / t.total AS frequency
    FROM counts c JOIN (SELECT year_month, sum(count) AS total FROM counts GROUP BY 1) t
      USING (year_month)""")

# --- sentiment, token by token with window lags ---------------------------------------------
PUNCT = "'^[[:punct:]]+|[[:punct:]]+$'"
cte("s_docs", ("comments",), f"""
    SELECT doc_id, year_month, body,
      list_transform(list_filter(regexp_split_to_array(body, '\\s+'), lambda t: t <> ''),
        lambda t: CASE WHEN length(regexp_replace(t, {PUNCT}, '', 'g')) <= 2 THEN t
                  ELSE regexp_replace(t, {PUNCT}, '', 'g') END) AS toks
    FROM comments""")
cte("s_doc", ("s_docs",), f"""
    SELECT doc_id, year_month, toks,
      (n_up > 0 AND n_up < n) AS cap_diff,
      coalesce(list_position(list_transform(toks, lambda x: lower(x)), 'but'), 0) AS but_pos,
      coalesce(least(n_ex, {EXCLAMATION_MAX}) * {EXCLAMATION_WEIGHT}
        + CASE WHEN n_q <= 1 THEN 0.0 WHEN n_q <= 3 THEN n_q * {QUESTION_WEIGHT}
               ELSE {QUESTION_MAX_WEIGHT} END, 0.0) AS amp
    FROM (SELECT *, len(toks) AS n,
            len(list_filter(toks, lambda x: upper(x) = x AND lower(x) <> x)) AS n_up,
            length(body) - length(replace(body, '!', '')) AS n_ex,
            length(body) - length(replace(body, '?', '')) AS n_q
          FROM s_docs)""")
cte("s_tok", ("s_doc",), """
    SELECT doc_id, cap_diff, but_pos, generate_subscripts(toks, 1) - 1 AS i,
           unnest(toks) AS t
    FROM s_doc""")
cte("s_ctx", ("s_tok",), """
    SELECT doc_id, cap_diff, but_pos, i, t, lower(t) AS w0,
      lag(lower(t), 1) OVER w AS w1, lag(t, 1) OVER w AS r1,
      lag(lower(t), 2) OVER w AS w2, lag(t, 2) OVER w AS r2,
      lag(lower(t), 3) OVER w AS w3, lag(t, 3) OVER w AS r3,
      lead(lower(t), 1) OVER w AS wn
    FROM s_tok WINDOW w AS (PARTITION BY doc_id ORDER BY i)""")


def _up(x: str) -> str:
    return f"(upper({x}) = {x} AND lower({x}) <> {x})"


_ctx_cols = []
_ctx_joins = []
for _d in (1, 2, 3):
    _ctx_cols.append(
        f"(l{_d}.word IS NOT NULL) AS lex{_d}, b{_d}.scalar AS boost{_d}, "
        f"(n{_d}.word IS NOT NULL OR coalesce(contains(k.w{_d}, 'n''t'), false)) AS neg{_d}, "
        f"{_up(f'k.r{_d}')} AS u{_d}")
    _ctx_joins.append(
        f"LEFT JOIN lex l{_d} ON l{_d}.word = k.w{_d} LEFT JOIN boo b{_d} ON b{_d}.word = k.w{_d} "
        f"LEFT JOIN neg n{_d} ON n{_d}.word = k.w{_d}")
cte("s_hit", ("s_ctx", "lex", "boo", "neg"), f"""
    SELECT k.doc_id, k.cap_diff, k.but_pos, k.i, k.w1, k.w2, k.w3, l0.valence,
      {_up('k.t')} AS u0, {', '.join(_ctx_cols)}
    FROM s_ctx k JOIN lex l0 ON l0.word = k.w0 LEFT JOIN boo b0 ON b0.word = k.w0
    {' '.join(_ctx_joins)}
    WHERE b0.word IS NULL AND NOT (k.w0 = 'kind' AND coalesce(k.wn = 'of', false))""")

# valence steps, one CTE each
cte("s_v0", ("s_hit",), f"""
    SELECT *, CASE WHEN u0 AND cap_diff THEN
      (CASE WHEN valence > 0 THEN valence + {CAPS_INCREMENT} ELSE valence - {CAPS_INCREMENT} END)
      ELSE valence END AS v FROM s_hit""")
_prev = "s_v0"
for _d in (1, 2, 3):
    applies = f"(i >= {_d} AND NOT lex{_d})"
    signed = f"(CASE WHEN v < 0 THEN -boost{_d} ELSE boost{_d} END)"
    capped = (f"(CASE WHEN u{_d} AND cap_diff THEN (CASE WHEN v > 0 THEN {signed} + {CAPS_INCREMENT} "
              f"ELSE {signed} - {CAPS_INCREMENT} END) ELSE {signed} END)")
    s = f"coalesce({capped} * {DISTANCE_DAMPING[_d - 1]}, 0.0)"
    cte(f"s_a{_d}", (_prev,), f"SELECT * REPLACE (CASE WHEN {applies} THEN v + {s} ELSE v END AS v) FROM {_prev}")
    if _d == 1:
        flip = "neg1"
        never = "false"
    elif _d == 2:
        never = "(w2 = 'never' AND w1 IN ('so', 'this'))"
        flip = f"(NOT {never} AND NOT (w2 = 'without' AND w1 = 'doubt') AND neg2)"
    else:
        never = "(w3 = 'never' AND (w2 IN ('so', 'this') OR w1 IN ('so', 'this')))"
        flip = f"(NOT {never} AND NOT (w3 = 'without' AND (w2 = 'doubt' OR w1 = 'doubt')) AND neg3)"
    cte(f"s_n{_d}", (f"s_a{_d}",), f"""
        SELECT * REPLACE (CASE WHEN {applies} AND {never} THEN v * {NEVER_SO_SCALAR}
                               WHEN {applies} AND {flip} THEN v * {NEGATION_SCALAR} ELSE v END AS v)
        FROM s_a{_d}""")
    _prev = f"s_n{_d}"
cte("s_val", (_prev,), f"""
    SELECT doc_id, v * (CASE WHEN but_pos = 0 THEN 1.0 WHEN i + 1 < but_pos THEN {BUT_BEFORE}
                            WHEN i + 1 > but_pos THEN {BUT_AFTER} ELSE 1.0 END) AS sv
    FROM (SELECT * REPLACE (CASE WHEN w1 = 'least' AND NOT lex1
                                  AND (i = 1 OR (i > 1 AND w2 NOT IN ('at', 'very')))
                             THEN v * {NEGATION_SCALAR} ELSE v END AS v) FROM {_prev})""")
cte("s_score", ("s_doc", "s_val"), f"""
    SELECT doc_id, year_month,
      round(greatest(least(x / sqrt(x * x + {NORMALIZE_ALPHA}), 1.0), -1.0), 4) AS compound
    FROM (SELECT d.doc_id, d.year_month,
            CASE WHEN s > 0 THEN s + amp WHEN s < 0 THEN s - amp ELSE coalesce(s, 0.0) END AS x
          FROM s_doc d LEFT JOIN (SELECT doc_id, round(sum(sv), 10) AS s FROM s_val GROUP BY doc_id) USING (doc_id))""")
cte("matched", ("toks", "bank"), "SELECT doc_id, year_month, word FROM toks WHERE word IN (SELECT word FROM bank)")
# Scores as whole ten-thousandths: exact sums, one division and one root at the end.
cte("sent", ("matched", "s_score"), """
    SELECT year_month, word, CAST(s1 AS DOUBLE) / (n * 10000e0) AS avg_sentiment,
           CASE WHEN n > 1 THEN sqrt(CAST(n * s2 - s1 * s1 AS DOUBLE) / (CAST(n AS DOUBLE) * CAST(n - 1 AS DOUBLE))) / 10000e0
           END AS stddev_sentiment
    FROM (SELECT m.year_month, m.word, count(*) AS n, sum(x) AS s1, sum(x * x) AS s2
          FROM matched m JOIN (SELECT doc_id, CAST(round(compound * 10000) AS BIGINT) AS x FROM s_score) USING (doc_id)
          GROUP BY m.year_month, m.word)""")
cte("words", ("freq", "sent", "stop"), """
    SELECT f.word, f.year_month, f.count, f.frequency, s.avg_sentiment, s.stddev_sentiment
    FROM freq f JOIN sent s USING (year_month, word)
    WHERE s.word NOT IN (SELECT word FROM stop)""")
cte("rollup", ("words",), """
    SELECT word, CAST(date_trunc('year', year_month) AS DATE) AS year,
           CAST(sum(count) AS BIGINT) AS yearly_count, avg(frequency) AS avg_frequency,
           avg(avg_sentiment) AS avg_sentiment
    FROM words GROUP BY 1, 2""")
cte("fspike", ("rollup",), """
    SELECT word, year, yearly_count, avg_frequency, x - p + x - n AS frequency_spike,
           CASE WHEN x - p + x - n IS NOT NULL THEN greatest(abs(x), abs(p), abs(n)) END AS size
    FROM (SELECT *, avg_frequency AS x, lag(avg_frequency) OVER w AS p, lead(avg_frequency) OVER w AS n
          FROM rollup WINDOW w AS (PARTITION BY word ORDER BY year))""")
MINC = TD.FIXTURE_YEARLY_MIN_COUNT
cte("sspike", ("rollup",), f"""
    SELECT word, year, yearly_count, avg_sentiment,
      avg_sentiment - lag(avg_sentiment) OVER (PARTITION BY word ORDER BY year)
      + avg_sentiment - lead(avg_sentiment) OVER (PARTITION BY word ORDER BY year) AS sentiment_spike_year
    FROM rollup WHERE yearly_count > {MINC}""")


def digits(x: str, size: str, n: int) -> str:
    """``x`` to ``n`` significant digits of ``size``."""
    scale = f"pow(10.0, {n - 1.0} - floor(log10(nullif({size}, 0))))"
    return f"CASE WHEN {size} = 0 THEN 0.0 ELSE round(({x}) * {scale}) / {scale} END"


def _ranked(src: str, metric: str, desc: bool, cols: str, where: str = "") -> str:
    order = "DESC" if desc else "ASC"
    key = digits(metric, "size", RANK_DIGITS) if src == "fspike" else f"round({metric}, {SENTIMENT_DECIMALS})"
    return f"""
    SELECT {cols}, rank FROM (
      SELECT *, CAST(RANK() OVER (PARTITION BY year ORDER BY {key} {order}) AS BIGINT) AS rank
      FROM {src} WHERE {metric} IS NOT NULL {where})
    WHERE rank <= 100"""


FCOLS = "word, year, yearly_count, avg_frequency, frequency_spike"
SCOLS = "word, year, yearly_count, sentiment_spike_year"
ACOLS = "word, year, avg_sentiment"
cte("t_top_f", ("fspike",), _ranked("fspike", "frequency_spike", True, FCOLS))
cte("t_bot_f", ("fspike",), _ranked("fspike", "frequency_spike", False, FCOLS))
cte("t_pos_s", ("sspike",), _ranked("sspike", "sentiment_spike_year", True, SCOLS))
cte("t_neg_s", ("sspike",), _ranked("sspike", "sentiment_spike_year", False, SCOLS))
cte("t_top_a", ("rollup",), _ranked("rollup", "avg_sentiment", True, ACOLS, f"AND yearly_count > {MINC}"))
cte("t_bot_a", ("rollup",), _ranked("rollup", "avg_sentiment", False, ACOLS, f"AND yearly_count > {MINC}"))
_TABLES = {  # word column, score column, ranked table, its metric
    "neg_word": ("negative_sentiment_spike", "t_neg_s", "sentiment_spike_year"),
    "pos_word": ("positive_sentiment_spike", "t_pos_s", "sentiment_spike_year"),
    "top_spike": ("top_frequency_spike", "t_top_f", "frequency_spike"),
    "top_sentiment_word": ("top_sentiment", "t_top_a", "avg_sentiment"),
    "bottom_sentiment_word": ("bottom_sentiment", "t_bot_a", "avg_sentiment"),
    "bottom_spike": ("bottom_frequency_spike", "t_bot_f", "frequency_spike"),
}
cte("charts", tuple(t for _, t, _ in _TABLES.values()), " UNION ALL ".join(
    f"SELECT '{score}' AS chart, year, rank, word, {metric} AS score FROM {t}" for score, t, metric in _TABLES.values()))
# Per year and rank one list of entries for each chart; ranks that any chart lacks go, and the
# lists of the others are spread out against each other.
cte("yearly", ("charts",), "SELECT r.year, "
    + ", ".join(f"{w}.e.word AS {w}, {w}.e.score AS {s}" for w, (s, *_) in _TABLES.items())
    + ", r.rank FROM (SELECT year, rank, "
    + ", ".join(f"list({{'word': word, 'score': score}}) FILTER (chart = '{s}') AS l_{w}" for w, (s, *_) in _TABLES.items())
    + f" FROM charts WHERE date_part('year', year) = {TD.FIXTURE_YEAR} GROUP BY year, rank"
    + " HAVING count(DISTINCT chart) = 6) r, "
    + ", ".join(f"unnest(r.l_{w}) AS {w}(e)" for w in _TABLES))
# The same lists zipped: the k-th of each chart's tied words, by word.
cte("positions", ("charts",), "SELECT year, rank, position, "
    + ", ".join(f"max(word) FILTER (chart = '{s}') AS {w}, max(score) FILTER (chart = '{s}') AS {s}"
                for w, (s, *_) in _TABLES.items())
    + " FROM (SELECT *, row_number() OVER (PARTITION BY chart, year, rank ORDER BY word) AS position FROM charts"
    + f" WHERE date_part('year', year) = {TD.FIXTURE_YEAR}) GROUP BY year, rank, position")
cte("bounds", ("words",), "SELECT min(year_month) AS lo, max(year_month) AS hi FROM words")
cte("cal", ("bounds",), """
    SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS year_month FROM bounds""")
_wanted = ", ".join("('" + w + "')" for w in
                    dict.fromkeys(x.strip() for x in TD.FIXTURE_LOOKUP.lower().split(",") if x.strip()))
cte("wanted", (), f"SELECT word FROM (VALUES {_wanted}) v(word)")
cte("found", ("words", "defs", "wanted"), """
    SELECT DISTINCT w.word FROM words w
    WHERE w.word IN (SELECT word FROM wanted) AND w.word IN (SELECT word FROM defs)""")
cte("series", ("words", "found", "cal"), """
    SELECT word, year_month, count, frequency, avg_sentiment,
           coalesce(stddev_sentiment, 0.0) AS stddev_sentiment
    FROM words WHERE word IN (SELECT word FROM found)
    UNION ALL
    SELECT f.word, c.year_month, CAST(0 AS BIGINT), 0.0, 0.0, 0.0
    FROM found f CROSS JOIN cal c
    WHERE NOT EXISTS (SELECT 1 FROM words w WHERE w.word = f.word AND w.year_month = c.year_month)""")
cte("summary", ("series", "defs"), f"""
    SELECT s.word, CAST(sum(s.count) AS BIGINT) AS total_count, avg(s.avg_sentiment) AS avg_avg_sentiment,
           d.definition
    FROM series s JOIN defs d USING (word) GROUP BY s.word, d.definition""")


def concise(x: str) -> str:
    return (f"CASE WHEN length(split_part({x}, '.', 1)) > 3 THEN split_part({x}, '.', 1) "
            f"ELSE split_part({x}, '.', 1) || split_part({x}, '.', 2) END")


def rnd(c: str) -> str:
    if "frequency" in c:
        return f"{digits(c, f'abs({c})', Q.SPIKE_DIGITS if 'spike' in c else Q.FREQUENCY_DIGITS)} AS {c}"
    return f"round({c}, {R}) AS {c}"


def with_ctes(final: str, *names: str) -> str:
    """``WITH`` clause holding ``names`` and everything they depend on, in order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return final
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order) + "\n" + final


FACT_OUT = "word, year_month, count, frequency, avg_sentiment, stddev_sentiment"
YEARLY_OUT = (f"year, neg_word, {rnd('negative_sentiment_spike')}, pos_word, {rnd('positive_sentiment_spike')}, "
              f"top_spike, {rnd('top_frequency_spike')}, top_sentiment_word, {rnd('top_sentiment')}, "
              f"bottom_sentiment_word, {rnd('bottom_sentiment')}, bottom_spike, {rnd('bottom_frequency_spike')}, rank")
def _sql() -> dict[str, str]:
    return {
        "comments_scan": with_ctes("SELECT doc_id, subreddit, body, year_month FROM comments", "comments"),
        "month_range_scan": with_ctes(
            f"SELECT doc_id, subreddit, year_month FROM comments "
            f"WHERE year_month BETWEEN DATE '{Q.RANGE_START}' AND DATE '{Q.RANGE_END}'", "comments"),
        "row_count": with_ctes("SELECT count(*) AS row_count FROM words", "words"),
        "tokenize": with_ctes(
            f"SELECT doc_id, generate_subscripts(t, 1) - 1 AS pos, unnest(t) AS token "
            f"FROM (SELECT doc_id, {tok('body')} AS t FROM comments)", "comments"),
        "parse_word_list": f"""
            SELECT doc_id, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS item FROM (
              SELECT doc_id, list_filter(list_transform(string_split(lower(text), ','),
                       lambda x: {strip('x')}), lambda x: x <> '') AS l FROM documents)""",
        "concise_definition": f"SELECT conv_id, turn, {concise('text')} AS concise_definition FROM conversations",
        "censor_words": with_ctes(
            "SELECT year, rank, " + ", ".join(
                f"CASE WHEN {c} IN (SELECT word FROM bad) THEN substr({c}, 1, 1) || repeat('*', length({c}) - 1) "
                f"ELSE {c} END AS {c}"
                for c in ("neg_word", "pos_word", "top_spike", "top_sentiment_word",
                          "bottom_sentiment_word", "bottom_spike")) + " FROM yearly", "yearly", "bad"),
        "word_counts": with_ctes("SELECT year_month, word, count FROM counts", "counts"),
        "word_frequencies": with_ctes("SELECT year_month, word, count, frequency FROM freq", "freq"),
        "top_words": with_ctes(f"""
            SELECT year_month, word, count, rank FROM (
              SELECT *, row_number() OVER (PARTITION BY year_month ORDER BY count DESC, word) AS rank
              FROM counts) WHERE rank <= {Q.TOP_WORDS_K}""", "counts"),
        "bigram_counts": _ngram_sql(2),
        "trigram_counts": _ngram_sql(3),
        "word_bank": with_ctes("SELECT word FROM bank", "bank"),
        "definitions": with_ctes("SELECT word, definition FROM defs", "defs"),
        "matched_tokens": with_ctes("SELECT doc_id, year_month, word FROM matched", "matched"),
        "matched_comments": with_ctes(
            "SELECT doc_id, year_month, count(*) AS n_matched FROM matched GROUP BY 1, 2", "matched"),
        "remove_stopwords": with_ctes(
            "SELECT year_month, word, count FROM counts WHERE word NOT IN (SELECT word FROM stop)",
            "counts", "stop"),
        "lexicon_sentiment": with_ctes("SELECT doc_id, year_month, compound FROM s_score", "s_score"),
        "sample_to_target": with_ctes(f"""
            SELECT doc_id, year_month FROM (
              SELECT doc_id, year_month, {Q.SAMPLE_TARGET} / count(*) OVER (PARTITION BY year_month) AS frac,
                CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '|{Q.SAMPLE_SEED}'), 1, 8)) AS BIGINT)
                  / {float(16 ** 8)} AS u
              FROM comments) WHERE frac >= 1.0 OR u < frac""", "comments"),
        "word_sentiment": with_ctes(
            "SELECT year_month, word, avg_sentiment, stddev_sentiment FROM sent", "sent"),
        "words_fact": with_ctes(f"SELECT {FACT_OUT} FROM words", "words"),
        "words_key_check": with_ctes("""
            SELECT count(*) AS duplicate_keys FROM (
              SELECT word, year_month FROM words GROUP BY 1, 2 HAVING count(*) > 1)""", "words"),
        "append_new_words": with_ctes(f"""
            SELECT {FACT_OUT} FROM words n
            WHERE n.year_month >= DATE '{Q.OFFERED_FROM}'
              AND NOT EXISTS (SELECT 1 FROM words e WHERE e.year_month < DATE '{Q.LOADED_BEFORE}'
                              AND e.word = n.word AND e.year_month = n.year_month)""", "words"),
        "distinct_words": with_ctes("SELECT DISTINCT word FROM words", "words"),
        "densify_months": with_ctes(f"""
            SELECT {FACT_OUT} FROM (
              SELECT word, year_month, count, frequency, avg_sentiment, stddev_sentiment FROM words
              UNION ALL
              SELECT w.word, c.year_month, CAST(0 AS BIGINT), 0.0, 0.0, 0.0
              FROM (SELECT DISTINCT word FROM words) w CROSS JOIN cal c
              LEFT JOIN words x ON x.word = w.word AND x.year_month = c.year_month
              WHERE x.word IS NULL)""", "words", "cal"),
        "yearly_frequency": with_ctes(
            f"SELECT word, year, yearly_count, {rnd('avg_frequency')} FROM rollup", "rollup"),
        "yearly_sentiment": with_ctes(
            f"SELECT word, year, yearly_count, {rnd('avg_sentiment')} FROM rollup", "rollup"),
        "frequency_spike": with_ctes(
            f"SELECT word, year, yearly_count, {rnd('avg_frequency')}, {rnd('frequency_spike')} FROM fspike",
            "fspike"),
        "sentiment_spike": with_ctes(
            f"SELECT word, year, yearly_count, {rnd('avg_sentiment')}, {rnd('sentiment_spike_year')} FROM sspike",
            "sspike"),
        "top_frequency_spikes": _freq_table("t_top_f"),
        "bottom_frequency_spikes": _freq_table("t_bot_f"),
        "positive_sentiment_spike": _spike_table("t_pos_s"),
        "negative_sentiment_spike": _spike_table("t_neg_s"),
        "top_sentiment": with_ctes(f"SELECT word, year, {rnd('avg_sentiment')}, rank FROM t_top_a", "t_top_a"),
        "bottom_sentiment": with_ctes(f"SELECT word, year, {rnd('avg_sentiment')}, rank FROM t_bot_a", "t_bot_a"),
        "word_explorer": with_ctes(f"SELECT {FACT_OUT} FROM series", "series"),
        "word_summary": with_ctes(
            f"SELECT word, total_count, {rnd('avg_avg_sentiment')}, definition, "
            f"{concise('definition')} AS concise_definition FROM summary", "summary"),
        "word_summary_display": with_ctes(
            "SELECT word, format('{:,}', total_count) AS total_count_text, "
            "format('{:,.2f}', avg_avg_sentiment) AS avg_sentiment_text FROM summary", "summary"),
        "words_not_found": with_ctes(
            "SELECT word FROM wanted WHERE word NOT IN (SELECT word FROM found)", "wanted", "found"),
        "yearly_words": with_ctes(f"SELECT {YEARLY_OUT} FROM yearly", "yearly"),
        "yearly_by_position": with_ctes(f"SELECT {YEARLY_OUT}, position FROM positions", "positions"),
        "fact_lookup": with_ctes(
            "SELECT w.word, w.year_month, w.count, w.frequency, w.avg_sentiment, w.stddev_sentiment "
            "FROM words w WHERE w.word IN (SELECT word FROM wanted)", "words", "wanted"),
        "trend_top10": with_ctes(f"""
            SELECT chart, position, word, CASE WHEN chart LIKE '%frequency%' THEN
              {digits('score', 'abs(score)', Q.SPIKE_DIGITS)} ELSE round(score, {R}) END AS score
            FROM (SELECT *, row_number() OVER (PARTITION BY chart ORDER BY rank, word) AS position
                  FROM charts WHERE date_part('year', year) = {TD.FIXTURE_YEAR}) WHERE position <= 10""", "charts"),
    }


def _ngram_sql(n: int) -> str:
    grams = (f"CASE WHEN len(t) >= {n} THEN list_transform(range(1, len(t) - {n} + 2), "
             f"lambda i: array_to_string(t[i:i + {n - 1}], ' ')) END")
    return with_ctes(f"""
        SELECT c.year_month, c.word, c.count, c.count / t.total AS frequency
        FROM (SELECT year_month, word, count(*) AS count FROM (
                SELECT year_month, unnest({grams}) AS word
                FROM (SELECT year_month, {tok('body')} AS t FROM comments)) GROUP BY 1, 2) c
        JOIN (SELECT year_month, sum(count) AS total FROM (
                SELECT year_month, count(*) AS count FROM (
                  SELECT year_month, unnest({grams}) AS word
                  FROM (SELECT year_month, {tok('body')} AS t FROM comments)) GROUP BY 1, word)
              GROUP BY 1) t USING (year_month)""", "comments")


def _freq_table(name: str) -> str:
    return with_ctes(f"SELECT word, year, yearly_count, {rnd('avg_frequency')}, {rnd('frequency_spike')}, rank "
                     f"FROM {name}", name)


def _spike_table(name: str) -> str:
    return with_ctes(f"SELECT word, year, yearly_count, {rnd('sentiment_spike_year')}, rank FROM {name}", name)


ORACLE_SQL: dict[str, str] = _sql()
