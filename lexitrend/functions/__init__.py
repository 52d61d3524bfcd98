"""Column-level helpers built from Spark's own functions."""

from .dates import month_from_parts, month_sequence, month_start, year_start, zero_padded_month
from .text import (
    censor,
    clean_text,
    concise_definition,
    first_piece,
    format_count,
    format_decimal,
    is_single_word,
    ngrams,
    parse_word_list,
    strip_ws,
    tokens,
)

__all__ = [
    "censor", "clean_text", "concise_definition", "first_piece", "format_count",
    "format_decimal", "is_single_word", "month_from_parts", "month_sequence", "month_start",
    "ngrams", "parse_word_list", "strip_ws", "tokens", "year_start", "zero_padded_month",
]
