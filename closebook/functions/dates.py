"""Date helpers: month keys and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(c: Column | str) -> Column:
    """Timestamp (incl. ``timestamp_ntz``) or date -> DATE."""
    c = F.col(c) if isinstance(c, str) else c
    return F.to_date(c)


def year_month(c: Column | str) -> Column:
    """'yyyy-MM' month key (string; sorts chronologically)."""
    return F.date_format(as_date(c), "yyyy-MM")


def year_of(c: Column | str) -> Column:
    return F.year(as_date(c)).cast("int")


def month_of(c: Column | str) -> Column:
    return F.month(as_date(c)).cast("int")


def quarter_of(c: Column | str) -> Column:
    return F.quarter(as_date(c)).cast("int")


def month_start(c: Column | str) -> Column:
    return F.trunc(as_date(c), "month")


def in_years(c: Column | str, first: int, last: int | None = None) -> Column:
    """``first <= year(c) <= last`` written as a date range on ``c``.

    Same rows as a filter on ``year(c)``, but a range on the date itself is
    unwrapped by Catalyst into timestamp bounds that reach the Parquet reader
    (PushedFilters), so row groups outside the years are skipped.
    """
    c = F.col(c) if isinstance(c, str) else c
    last = first if last is None else last
    return ((c >= F.lit(f"{first:04d}-01-01").cast("date"))
            & (c < F.lit(f"{last + 1:04d}-01-01").cast("date")))


def month_key(c: Column | str) -> Column:
    """First day of the month as a DATE: a cheap grouping key (integer truncation).

    Aggregations group on it and format the 'yyyy-MM' label on the aggregated
    rows only, instead of formatting a string for every line.
    """
    return F.trunc(as_date(c), "month")


def month_parts(m: Column | str) -> list[Column]:
    """(ym, yr, mo) derived from a month-start DATE column."""
    m = F.col(m) if isinstance(m, str) else m
    return [F.date_format(m, "yyyy-MM").alias("ym"), F.year(m).alias("yr"),
            F.month(m).alias("mo")]
