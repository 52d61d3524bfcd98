"""lexitrend: word trends and comment sentiment as plain Spark DataFrame jobs.

Layout
------
functions/  Column -> Column helpers (tokenising, n-grams, formatting, censoring)
sources/    readers and writers (JSON archive, Parquet layout, word lists, CSV dictionary)
operators/  DataFrame -> DataFrame steps (counts, bank, sentiment, fact, trends, reads)
plans/      end-to-end batch jobs that chain operators and write their results
streaming/  incremental month loading with Structured Streaming
"""

__all__ = ["constants", "schemas", "session"]
