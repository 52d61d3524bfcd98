"""Month and year helpers. Months are first-of-month DATEs; years are first-of-year DATEs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(ts: Column | str) -> Column:
    """First day of the month of a date or timestamp, as DATE."""
    return F.trunc(F.to_date(_col(ts)), "month")


def year_start(d: Column | str) -> Column:
    """First day of the year, as DATE (``date_trunc('year', d)`` cast to DATE)."""
    return F.trunc(F.to_date(_col(d)), "year")


def month_from_parts(year: Column | str, month: Column | str) -> Column:
    """``make_date(year, month, 1)`` from partition values such as ``year=2007/month=07``."""
    return F.make_date(_col(year).cast("int"), _col(month).cast("int"), F.lit(1))


def month_sequence(start: Column, end: Column) -> Column:
    """Every first of month from ``start`` to ``end`` inclusive (empty when start > end)."""
    return F.when(start <= end, F.sequence(start, end, F.expr("interval 1 month"))).otherwise(
        F.array().cast("array<date>"))


def zero_padded_month(month: Column | str) -> Column:
    """``7`` -> ``'07'``."""
    return F.lpad(_col(month).cast("string"), 2, "0")
