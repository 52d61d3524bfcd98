"""Fixed values.

Everything here is a value that must stay as written for results to agree with the word-trend
and sentiment semantics this library reproduces. Nothing is derived; change a value only on
purpose.
"""

from __future__ import annotations

# --- Fixed values: tokenising -------------------------------------------------------------
# Characters removed before splitting: anything not an ASCII word character or whitespace.
NON_WORD_PATTERN = r"[^\w\s]"
# Token separator.
WHITESPACE_PATTERN = r"\s+"

# --- Fixed values: yearly trend tables ------------------------------------------------------
# Sentiment tables keep word-years whose summed count is above this value.
YEARLY_MIN_COUNT = 100_000
# Rows kept per year, by RANK() (ties share a rank, so a year may hold more rows).
TOP_K = 100
# Float-sum order must not decide a tie: frequency spikes are ranked to this many significant
# digits of the frequencies they compare, sentiment metrics (range -1 to 1) to these decimals.
RANK_DIGITS = 11
SENTIMENT_DECIMALS = 12

# --- Fixed values: the yearly read ---------------------------------------------------------
# Years offered by the yearly read.
YEARLY_READ_YEARS = (2011, 2012, 2013, 2014)

# --- Fixed values: concise definition -------------------------------------------------------
# The text before the first "." is used when it is longer than this many characters.
CONCISE_MIN_CHARS = 3

# --- Fixed values: bad-word list additions ---------------------------------------------------
BAD_WORD_EXTRAS = ("rape", "rapes", "raped", "raping", "rapist", "fagt")

# --- Fixed values: the six word columns of the yearly read -----------------------------------
YEARLY_WORD_COLUMNS = (
    "neg_word",
    "pos_word",
    "top_spike",
    "top_sentiment_word",
    "bottom_sentiment_word",
    "bottom_spike",
)

# --- Fixed values: lexicon sentiment (published VADER rules, Hutto & Gilbert 2014) ----------
CAPS_INCREMENT = 0.733
NEGATION_SCALAR = -0.74
NORMALIZE_ALPHA = 15.0
EXCLAMATION_WEIGHT = 0.292
EXCLAMATION_MAX = 4
QUESTION_WEIGHT = 0.18
QUESTION_MAX_WEIGHT = 0.96
BUT_BEFORE = 0.5
BUT_AFTER = 1.5
# Booster effect by distance 1, 2, 3 from the scored word.
DISTANCE_DAMPING = (1.0, 0.95, 0.9)
# "never so <word>" / "never this <word>" emphasis.
NEVER_SO_SCALAR = 1.25
COMPOUND_DECIMALS = 4
