"""Filters shared by the analyses."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.dates import year_start_on_or_after


def _d(start) -> dt.date:
    if isinstance(start, dt.datetime):  # a timestamp literal would not compare as a date
        return start.date()
    return start if isinstance(start, dt.date) else dt.date.fromisoformat(str(start))


YEAR_PARTITION = "InvoiceYear"  # storage partition column of the cleaned table


def _from(sales: DataFrame, first: dt.date) -> DataFrame:
    out = sales.where(F.col("InvoiceDate") >= F.lit(first))
    if YEAR_PARTITION in sales.columns:
        # implied by the date test; stated so the scan prunes year folders
        out = out.where(F.col(YEAR_PARTITION) >= first.year)
    return out


def since(sales: DataFrame, start, customers_only: bool = False) -> DataFrame:
    """``InvoiceDate >= start`` [and ``CustomerID is not null``]; a plain
    comparison with a literal, so it reaches the Parquet scan (and prunes
    year folders of the cleaned table)."""
    out = sales if start is None else _from(sales, _d(start))
    return out.where(F.col("CustomerID").isNotNull()) if customers_only else out


def since_year_of(sales: DataFrame, start) -> DataFrame:
    """``date_trunc('year', InvoiceDate) >= start``, rewritten to a pushable
    comparison (exactly equivalent)."""
    if start is None:
        return sales
    return _from(sales, year_start_on_or_after(_d(start)))
