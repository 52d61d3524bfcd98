"""Column -> Column text functions. All are built-in Spark expressions (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import CONCISE_MIN_CHARS, NON_WORD_PATTERN, WHITESPACE_PATTERN


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(body: Column | str) -> Column:
    """Lower-case and delete every character that is not an ASCII word character or whitespace.

    Accented letters are deleted, apostrophes vanish (``don't`` -> ``dont``), ``_`` stays.
    """
    return F.regexp_replace(F.lower(_col(body)), NON_WORD_PATTERN, "")


def tokens(body: Column | str) -> Column:
    """Token list of a comment: ``split(clean_text(body), '\\s+')``.

    Leading or trailing whitespace yields an empty-string token, which is kept (it is counted by
    the word-count job). A NULL body gives a NULL list, so ``explode`` emits nothing for it.
    Pass this expression straight into ``explode``: exploding a projected column would make the
    optimizer re-evaluate the regex in an inferred ``size(...) > 0`` filter.
    """
    return F.split(clean_text(body), WHITESPACE_PATTERN)


def ngrams(token_list: Column, n: int) -> Column:
    """n-grams of a token list: consecutive ``n`` tokens joined by one space.

    Fewer than ``n`` tokens give an empty list; a NULL list stays NULL. ``n == 1`` is the list.
    The list expression is bound once through a one-element array, so the tokeniser runs once
    per row however often the n-gram expression refers to it. Each n-gram is one string put together
    from its tokens; no list is cut out per n-gram.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    if n == 1:
        return token_list

    def grams(t: Column) -> Column:
        return F.when(
            F.size(t) >= n,
            F.transform(F.slice(t, F.lit(1), F.size(t) - (n - 1)),
                        lambda x, i: F.concat_ws(" ", x, *[F.get(t, i + k) for k in range(1, n)])),
        ).when(t.isNotNull(), F.array().cast("array<string>"))

    return F.transform(F.array(token_list), grams).getItem(0)



def strip_ws(text: Column | str) -> Column:
    """Remove leading and trailing whitespace of any kind (``trim`` removes spaces only)."""
    return F.regexp_replace(_col(text), r"^\s+|\s+$", "")


def parse_word_list(text: Column | str) -> Column:
    """Parse a comma separated word list: lower, split on ``,``, strip, drop empty items."""
    parts = F.transform(F.split(F.lower(_col(text)), ","), strip_ws)
    return F.filter(parts, lambda x: x != "")


def concise_definition(definition: Column | str) -> Column:
    """Text before the first ``.`` when it is longer than 3 characters, else the first two
    pieces joined (a missing second piece counts as empty)."""
    d = _col(definition)
    first = F.substring_index(d, ".", 1)
    second = F.substring_index(F.substring_index(d, ".", 2), ".", -1)
    has_second = F.instr(d, ".") > 0
    return (
        F.when(F.length(first) > CONCISE_MIN_CHARS, first)
        .otherwise(F.concat(first, F.when(has_second, second).otherwise(F.lit(""))))
    )


def censor(word: Column | str, is_bad: Column) -> Column:
    """First character then one ``*`` per remaining character, where ``is_bad`` holds."""
    w = _col(word)
    masked = F.concat(F.substring(w, 1, 1), F.repeat(F.lit("*"), F.greatest(F.length(w) - 1, F.lit(0))))
    return F.when(is_bad, masked).otherwise(w)


def format_decimal(x: Column | str, places: int = 2) -> Column:
    """``1,234.57`` style text (thousands separator, fixed decimals)."""
    return F.format_number(_col(x), places)


def format_count(x: Column | str) -> Column:
    """``1,234`` style text for whole numbers."""
    return F.format_number(_col(x), 0)


def first_piece(text: Column | str) -> Column:
    """Text up to the first ``.`` or ``,`` (used to turn a sentence into a dictionary key)."""
    return F.regexp_extract(_col(text), r"^[^.,]+", 0)


def is_single_word(word: Column | str, any_whitespace: bool) -> Column:
    """One piece after splitting.

    ``any_whitespace=False``: split on one space, so ``"a b"`` is two pieces but ``" a"`` is too.
    ``any_whitespace=True``: split on runs of whitespace after trimming; blank is not a word.
    """
    w = _col(word)
    if any_whitespace:
        t = strip_ws(w)
        return (F.size(F.split(t, WHITESPACE_PATTERN)) == 1) & (t != "")
    return F.size(F.split(w, " ")) == 1
