"""Batch jobs: the monthly archive processed end to end, one Spark job per step.

Each job reads its inputs, builds one lazy plan over *all* requested months and writes once;
there are no per-month driver loops. Monthly outputs are swapped in month by month, so a re-run of
some months replaces exactly those months (and empties those of its bounds that have no rows now).

    convert_archive     JSON archive -> comment Parquet (year=/month=)
    word_freqs          comment Parquet -> {n}_gram_counts (year=/month=)
    sentiment           comment Parquet + dictionary + stopwords + lexicon -> sentiment
    load_words          n-gram counts + sentiment -> words fact table (months replaced)
    load_definitions    dictionary -> word_definitions
    zero_fill           words -> words plus zero rows for calendar months a word lacks (changes only)
    yearly_tables       words -> six yearly tables
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from .. import schemas
from ..operators import bank as B
from ..operators import fact as FT
from ..operators import frequency as FQ
from ..operators import sentiment as S
from ..operators import trends as TR
from ..operators import explore as X
from ..sources import comments as SC
from ..sources import lists as L
from ..sources import sinks as SK
from ..sources.swap import Folder, recover
from ..session import ensure_checkpoint_dir


ARCHIVE_STATE = "_archive.json"


def convert_archive(spark: SparkSession, raw_root: str, out: str, glob: str = "*/*") -> list[str]:
    """Write the JSON archive as comment Parquet; returns the files that were read.

    Path, length and time of change of every converted file are kept with ``out`` (one entry per
    archive file), and a later run reads only files that are new or changed, with the other files of
    their months, as a month is replaced whole. A file that has left the archive leaves its month."""
    table = Folder(spark, out)
    listed = {path: [size, changed] for path, size, changed in Folder(spark, raw_root).glob(f"{raw_root.rstrip('/')}/{glob}")}
    state = f"{table.path}/{ARCHIVE_STATE}"
    known = json.loads(table.read(state)) if table.exists(state) else {}
    months = {SC.month_of_path(p) for p, what in listed.items() if known.get(p) != what}
    files = [p for p in listed if SC.month_of_path(p) in months]
    if files:
        SC.write_comment_parquet(SC.read_archive(spark, raw_root, glob, files), out)
        table.write(state, json.dumps({**known, **{p: listed[p] for p in files}}))
    return files


def word_freqs(spark: SparkSession, comments_root: str, out_root: str, ns=(1,),
               start: str | None = None, end: str | None = None) -> None:
    """``{n}_gram_counts`` for each n, for the months in ``[start, end]``."""
    comments = SC.read_comment_parquet(spark, comments_root, start, end)
    for n in ns:
        SK.write_monthly(FQ.monthly_ngrams(comments, n), f"{out_root.rstrip('/')}/{n}_gram_counts", span=(start, end))


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated lexicon: ``word <TAB> valence [<TAB> ...]`` (extra columns ignored)."""
    df = spark.read.option("sep", "\t").option("header", False).csv(path)
    return df.select(F.col("_c0").alias("word"), F.col("_c1").cast("double").alias("valence")) \
        .filter(F.col("word").isNotNull() & F.col("valence").isNotNull())


def read_boosters(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``word <TAB> scalar`` (e.g. ``very 0.293``, ``barely -0.293``)."""
    df = spark.read.option("sep", "\t").option("header", False).csv(path)
    return df.select(F.col("_c0").alias("word"), F.col("_c1").cast("double").alias("scalar"))


def sentiment(spark: SparkSession, comments_root: str, dictionary_csv: str, stopwords_path: str,
              lexicon: DataFrame, boosters: DataFrame | None, negations: DataFrame | None,
              out: str, start: str | None = None, end: str | None = None,
              target: int | None = None, seed: int = 0, idioms: DataFrame | None = None) -> None:
    """Monthly sentiment of bank words over every comment of ``[start, end]`` (all months by
    default), or over a sample of about ``target`` comments a month when a target is given."""
    ensure_checkpoint_dir(spark)
    comments = SC.read_comment_parquet(spark, comments_root, start, end)
    bank = B.word_bank(L.read_dictionary(spark, dictionary_csv).select("word"), read_stopwords(spark, stopwords_path))
    result = S.monthly_word_sentiment(comments, bank, lexicon, boosters, negations,
                                      target=target, seed=seed, idioms=idioms)
    SK.write_monthly(result, out, span=(start, end))


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    return L.read_word_list(spark, path)


def load_words(spark: SparkSession, ngram_path: str, sentiment_path: str, stopwords_path: str,
               words_out: str, start: str | None = None, end: str | None = None) -> None:
    """Join counts and sentiment of ``[start, end]`` into the fact table (``year=/month=``, sorted
    by word), replacing those months; months within the bounds that have no facts now are emptied.
    Only their partitions are read. Raises when a
    ``(word, year_month)`` key occurs more than once; the table is then left as it was."""
    ensure_checkpoint_dir(spark)
    counts = SK.read_monthly(spark, ngram_path, start, end, schemas.NGRAM_COUNTS)
    sent = SK.read_monthly(spark, sentiment_path, start, end, schemas.WORD_SENTIMENT)
    new = FT.words_fact(counts, sent, read_stopwords(spark, stopwords_path)).checkpoint(eager=True)
    double = FT.key_duplicates(new).first()[0]
    if double:
        raise ValueError(f"{double} (word, year_month) keys occur more than once; nothing was written")
    SK.write_monthly(new, words_out, span=(start, end))


def load_definitions(spark: SparkSession, dictionary_csv: str, out: str) -> None:
    SK.overwrite(B.definitions(L.read_dictionary(spark, dictionary_csv, skip_long_lines=True)), out)


FILL_STATE, FILL_BITMAPS = "_fill.json", "_bitmaps"


def zero_fill(spark: SparkSession, words_path: str, out: str, start: str | None = None,
              end: str | None = None) -> list[dt.date]:
    """Write the fact table plus zero rows for every calendar month a word lacks; the calendar is
    the table's own unless bounds are given. ``out`` must be another table: a table cannot be
    replaced while it is read. Returns the months that were written or added to.

    One bitmap of present months per word is kept with ``out``, and which files each month was made
    from. A later run reads only the months whose files changed: it replaces those (and calendar
    months that are new), and adds to other months the zero rows of words never seen before. Nothing
    is written if nothing changed. When a word has lost its last row, or the calendar begins earlier
    or became shorter, the table is made anew. Bitmaps and months are swapped in together."""
    if SK.same_path(spark, words_path, out):
        raise ValueError("zero_fill cannot write to the table it reads")
    ensure_checkpoint_dir(spark)
    source, table = Folder(spark, words_path), Folder(spark, out)
    recover(table)
    words = SK.read_monthly(spark, words_path, schema=schemas.WORDS)
    made_from = {m: [[n, size] for n, size, _ in source.files(f"{source.path}/{f}")] for m, f in source.months().items()}
    made_from = {m: f for m, f in made_from.items() if f}
    bounds = [dt.date.fromisoformat(str(x)).replace(day=1) if x else None for x in (start, end)]
    first, last = bounds[0] or min(made_from, default=None), bounds[1] or max(made_from, default=None)
    calendar = FT.months_between(first, last) if first and last else []
    every = sorted({*calendar, *made_from})
    if not every:
        return SK.write_monthly(words.select(*FT.FACT_COLUMNS), out, span=(None, None))
    state = {"first": str(first), "last": str(last), "base": FT.month_number(every[0]),
             "made_from": {str(m): f for m, f in made_from.items()}}
    slots = FT.slots_of(every[0], every[-1])
    old = json.loads(table.read(f"{table.path}/{FILL_STATE}")) if table.exists(f"{table.path}/{FILL_STATE}") else None
    if old is not None and old["base"] <= state["base"] and old["first"] == state["first"] and old["last"] <= state["last"]:
        state["base"] = old["base"]
        slots = FT.slots_of(FT.month_of(old["base"]), every[-1])
        written = _fill_changes(spark, words, out, table, old, state, calendar, slots)
        if written is not None:
            return written
    bitmaps = FT.month_bitmaps(words, state["base"], slots).checkpoint(eager=True)
    full = words.select(*FT.FACT_COLUMNS).unionByName(FT.zero_rows(FT.gaps(bitmaps, state["base"], calendar)))
    return SK.write_monthly(full, out, span=(None, None), side={FILL_STATE: json.dumps(state), FILL_BITMAPS: bitmaps})


def _fill_changes(spark: SparkSession, words: DataFrame, out: str, table: Folder, old: dict, state: dict,
                  calendar: list[dt.date], slots: int) -> list[dt.date] | None:
    """The changes since the last fill; None if the table must be made anew."""
    known, now = old["made_from"], state["made_from"]
    changed = {dt.date.fromisoformat(m) for m in {*known, *now} if known.get(m) != now.get(m)}
    before = FT.months_between(*(dt.date.fromisoformat(old[k]) for k in ("first", "last")))
    rewrite = sorted(changed | set(calendar) - set(before))
    if not rewrite:
        return []
    facts = words.filter(F.col("year_month").isin(sorted(changed)) if changed else F.lit(False))
    mask = [0] * slots
    for n in (FT.month_number(m) - state["base"] for m in changed):
        mask[n // 64] |= 1 << n % 64
    keep = [F.lit(~x if x < 1 << 63 else ~(x - (1 << 64))).cast("long") for x in mask]
    had = spark.read.schema("word string, bits array<long>").parquet(f"{table.path}/{FILL_BITMAPS}").select(
        "word", F.array(*[F.coalesce(F.get("bits", F.lit(k)), F.lit(0).cast("long")).bitwiseAND(keep[k])
                          for k in range(slots)]).alias("bits"), F.lit(1).alias("seen"))
    fresh = FT.month_bitmaps(facts, state["base"], slots).withColumn("seen", F.lit(0))
    bitmaps = FT.merge_bitmaps(had.unionByName(fresh), slots, "seen").checkpoint(eager=True)
    if not bitmaps.filter(F.forall("bits", lambda b: b == 0)).isEmpty():
        return None
    rest = [m for m in calendar if m not in set(rewrite)]
    zero = FT.gaps(bitmaps, state["base"], [m for m in rewrite if m in set(calendar)]).unionByName(
        FT.gaps(bitmaps.filter("seen = 0"), state["base"], rest))
    rows = facts.select(*FT.FACT_COLUMNS).unionByName(FT.zero_rows(zero))
    return SK.write_monthly(rows, out, months=rewrite, append=rest, side={
        FILL_STATE: json.dumps(state), FILL_BITMAPS: bitmaps.select("word", "bits")})


def lookup(spark: SparkSession, words_path: str, definitions_path: str, word_list: str, start: str | None = None,
           end: str | None = None) -> DataFrame:
    """The word explorer over written tables: of the fact table only files whose range of words can
    hold a requested one are opened; the calendar comes from the table's folders."""
    months = Folder(spark, words_path).months()
    if not months:
        return spark.createDataFrame([], schemas.WORDS)
    facts = SK.read_words(spark, words_path, X.parse_words(word_list), schemas.WORDS, start, end)
    return X.word_explorer(facts, spark.read.parquet(definitions_path), word_list,
                           start or min(months), end or max(months))


def yearly_tables(spark: SparkSession, words_path: str, out_root: str,
                  min_count: int = C.YEARLY_MIN_COUNT, k: int = C.TOP_K) -> None:
    """The six yearly tables. The roll-up is checkpointed once and feeds all six."""
    ensure_checkpoint_dir(spark)
    rollup = TR.yearly_rollup(SK.read_monthly(spark, words_path)).checkpoint(eager=True)
    for name, df in TR.yearly_trends(rollup, min_count, k).items():
        SK.overwrite(df, f"{out_root.rstrip('/')}/{name}")


def read_yearly_tables(spark: SparkSession, out_root: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{out_root.rstrip('/')}/{name}") for name in TR.TABLES}


def read_yearly_table(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    """One yearly table in the order it is shown: by year, rank and word."""
    return X.ordered(spark.read.parquet(f"{out_root.rstrip('/')}/{name}"))
