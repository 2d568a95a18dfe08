"""Date functions with PostgreSQL / lubridate semantics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def month_start(col) -> Column:
    """date_trunc('month', d)::date"""
    return F.trunc(_c(col), "month")


def week_start(col) -> Column:
    """date_trunc('week', d)::date: the Monday on or before d (no time zone involved)."""
    return F.next_day(F.date_sub(_c(col), 7), "Mon")


def month_name(col) -> Column:
    """to_char(d, 'FMMonth'): unpadded English month name."""
    return F.date_format(_c(col), "MMMM")


def month_year_label(col) -> Column:
    """to_char(d, 'FMMonth YYYY')"""
    return F.date_format(_c(col), "MMMM yyyy")


def quarter_label(col) -> Column:
    """to_char(d, '"Q"Q YYYY')"""
    d = _c(col)
    return F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.lit(" "), F.year(d).cast("string"))


def week_of_year_7day(col) -> Column:
    """lubridate::week: complete 7-day periods since 1 January, plus one.

    Not the ISO week: 2018-12-31 is week 53 here and week 1 in ISO.
    """
    return ((F.dayofyear(_c(col)) - 1) / 7).cast("bigint") + 1


def age_day(ref, col) -> Column:
    """date_part('day', age(ref, d)) for ref >= d: the day *component* of the
    symbolic year/month/day difference, borrowing the length of d's month."""
    r, d = _c(ref), _c(col)
    diff = F.dayofmonth(r) - F.dayofmonth(d)
    return F.when(diff >= 0, diff).otherwise(diff + F.dayofmonth(F.last_day(d))).cast("bigint")


def year_start_on_or_after(start: dt.date | str) -> dt.date:
    """``date_trunc('year', d) >= start`` holds exactly when ``d`` is on or
    after the first 1 January that is not before ``start``.  Rewriting the
    predicate this way lets the Parquet scan push it down."""
    s = dt.date.fromisoformat(str(start)) if not isinstance(start, dt.date) else start
    return s if (s.month, s.day) == (1, 1) else dt.date(s.year + 1, 1, 1)
