"""Command line of the batch jobs: ``python -m lexitrend.jobs <job> --start --end ...``.

The session comes from the launcher (``spark-submit`` or the session's own settings); only the
job's arguments are read here.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from . import constants as C
from .plans import jobs as J
from .sources import lists as L


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lexitrend.jobs", description="Monthly comment jobs.")
    jobs = p.add_subparsers(dest="job", required=True)

    def job(name: str, *paths: str, months: bool = True) -> argparse.ArgumentParser:
        j = jobs.add_parser(name)
        for path in paths:
            j.add_argument(f"--{path}", required=True)
        if months:
            j.add_argument("--start", help="first month, YYYY-MM-01 (default: all)")
            j.add_argument("--end", help="last month, YYYY-MM-01 (default: all)")
        return j

    job("convert_archive", "raw", "out", months=False).add_argument("--glob", default="*/*")
    job("word_freqs", "comments", "out").add_argument("--n", type=int, nargs="+", default=[1])
    s = job("sentiment", "comments", "dictionary", "stopwords", "lexicon", "out")
    for option in ("boosters", "negations", "idioms"):
        s.add_argument(f"--{option}")
    s.add_argument("--target", type=int, help="sample about so many comments a month (default: all)")
    s.add_argument("--seed", type=int, default=0)
    job("load_words", "ngrams", "sentiment", "stopwords", "out")
    job("load_definitions", "dictionary", "out", months=False)
    job("zero_fill", "words", "out")
    y = job("yearly_tables", "words", "out", months=False)
    y.add_argument("--min-count", type=int, default=C.YEARLY_MIN_COUNT)
    y.add_argument("--k", type=int, default=C.TOP_K)
    return p


def run(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.job == "convert_archive":
        J.convert_archive(spark, a.raw, a.out, a.glob)
    elif a.job == "word_freqs":
        J.word_freqs(spark, a.comments, a.out, a.n, a.start, a.end)
    elif a.job == "sentiment":
        J.sentiment(spark, a.comments, a.dictionary, a.stopwords, J.read_lexicon(spark, a.lexicon),
                    J.read_boosters(spark, a.boosters) if a.boosters else None,
                    L.read_word_list(spark, a.negations) if a.negations else None, a.out, a.start, a.end,
                    a.target, a.seed,
                    J.read_lexicon(spark, a.idioms).withColumnRenamed("word", "phrase") if a.idioms else None)
    elif a.job == "load_words":
        J.load_words(spark, a.ngrams, a.sentiment, a.stopwords, a.out, a.start, a.end)
    elif a.job == "load_definitions":
        J.load_definitions(spark, a.dictionary, a.out)
    elif a.job == "zero_fill":
        J.zero_fill(spark, a.words, a.out, a.start, a.end)
    else:
        J.yearly_tables(spark, a.words, a.out, a.min_count, a.k)


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    run(SparkSession.builder.appName(f"lexitrend-{args.job}").getOrCreate(), args)


if __name__ == "__main__":
    main()
