"""The queries of the training-data operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    op1_near_dedup,
    op2_toxicity,
    op3_licenses,
    op4_quality,
    op5_decontaminate,
    op6_packing,
    op7_exact_dedup,
    op8_token_file,
    op9_pii,
    op10_html_extract,
    op11_spelling,
    op12_language_id,
    op13_lexical_search,
)
from .common import table


def op7_exact_dedup_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def tokenizer(name: str) -> str:
    """Where the installed public tokenizer file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_near_dedup_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_near_dedup.near_classes(table(spark, sf_dir, "documents"))


def op2_toxicity_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_licenses_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_licenses.scan(table(spark, sf_dir, "documents"))


def op4_quality_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_decontaminate_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), word_edges=True)


def op6_packing_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), 2)


def op8_token_file_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_token_file.round_trip(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), 2)


def op9_pii_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_pii.find(table(spark, sf_dir, "documents"))


def op10_html_extract_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_html_extract.extract(table(spark, sf_dir, "pages"))


def op11_spelling_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_spelling.variants(table(spark, sf_dir, "documents"))


def op12_language_id_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_language_id.predict(table(spark, sf_dir, "documents"))


def op13_lexical_search_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_lexical_search.search_all(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op7_exact_dedup": op7_exact_dedup_q,
    "op1_near_dedup": op1_near_dedup_q,
    "op2_toxicity": op2_toxicity_q,
    "op3_licenses": op3_licenses_q,
    "op4_quality": op4_quality_q,
    "op5_decontaminate": op5_decontaminate_q,
    "op6_packing": op6_packing_q,
    "op8_token_file": op8_token_file_q,
    "op9_pii": op9_pii_q,
    "op10_html_extract": op10_html_extract_q,
    "op11_spelling": op11_spelling_q,
    "op12_language_id": op12_language_id_q,
    "op13_lexical_search": op13_lexical_search_q,
}

ORACLE_SQL: dict[str, str] = {
    "op7_exact_dedup": op7_exact_dedup.ORACLE,
    "op13_lexical_search": op13_lexical_search.ORACLE,
}
