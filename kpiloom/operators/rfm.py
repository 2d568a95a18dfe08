"""Recency, frequency, monetary scoring and segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.dates import age_day
from kpiloom.operators.common import since
from kpiloom.plans.selection import ntiles

# The eleven segments in the reference's order, each with its
# recency range and the range shared by the frequency and monetary scores
# (inclusive).  The first matching row wins; no match gives 'other'.
SEGMENTS = [
    ("Champions", 4, 5, 4, 5),
    ("Loyal Customers", 2, 5, 2, 5),
    ("Potential Loyalist", 3, 5, 1, 3),
    ("Recent Customers", 4, 5, 0, 1),
    ("Promising", 3, 4, 0, 1),
    ("Customers Needing Attention", 2, 3, 2, 3),
    ("About To Sleep", 2, 3, 0, 2),
    ("At Risk", 0, 2, 2, 5),
    ("Cant Lose Them", 0, 1, 4, 5),
    ("Hibernating", 1, 2, 1, 2),
    ("Lost", 0, 2, 0, 2),
]
OTHER_SEGMENT = "other"
# Labels of the three-tier scheme, for scores 1, 2, 3.
RECENCY_LABELS = ("Long_standing_customer", "Relatively_recent_customer", "Recent_customer")
FREQUENCY_LABELS = ("Purchases_rarely", "Purchases_infrequently", "Purchases_frequently")
MONETARY_LABELS = ("Low_value_purchases", "Average_value_purchases", "High_value_purchases")


def _by_code() -> list[Column]:
    """Final order of the scored lists: the customer breaks the few codes into many sort keys."""
    return [F.desc_nulls_first("rfm_combined"), F.asc_nulls_last("customer_id")]


def rfm_base(sales: DataFrame, start=None, *, per_customer: DataFrame | None = None) -> DataFrame:
    """Per identified customer: last purchase date, distinct purchase
    *days*, and revenue.  Lines collapse to (customer, day) first, so the
    distinct count needs no Expand and the second shuffle carries day totals.
    ``per_customer`` (see plans.report.customer_summary) skips the aggregation."""
    if per_customer is not None:
        return per_customer.select("customer_id", "most_recent_date", "counts_freq",
                                   F.col("revenue").cast("double").alias("monetary"))
    daily = (since(sales, start, customers_only=True)
             .groupBy("CustomerID", "InvoiceDate").agg(F.sum("rev").alias("_day_rev")))
    return daily.groupBy(F.col("CustomerID").alias("customer_id")).agg(
        F.max("InvoiceDate").alias("most_recent_date"),
        F.count("InvoiceDate").alias("counts_freq"),
        F.sum("_day_rev").cast("double").alias("monetary"))


def reference_date(sales: DataFrame):
    """The latest InvoiceDate of the whole table, as a scalar-subquery column."""
    return sales.agg(F.max("InvoiceDate")).scalar()


def _date_diff(ref, recency: str):
    if recency == "age_day":
        return age_day(ref, F.col("most_recent_date"))
    if recency == "total_days":
        return F.datediff(ref, F.col("most_recent_date")).cast("bigint")
    raise ValueError(f"unknown recency {recency!r}")


def _ref_column(base: DataFrame, ref, sales: DataFrame | None) -> Column:
    if ref is None:
        return reference_date(sales) if sales is not None else base.agg(F.max("most_recent_date")).scalar()
    return ref if isinstance(ref, Column) else F.lit(ref).cast("date")


def rfm_recency(base: DataFrame, ref=None, recency: str = "age_day", sales: DataFrame | None = None) -> DataFrame:
    """R2: customer_id, date_diff.  ``age_day`` keeps only the day component
    of age(ref, last) as the reference does (0 for 2011-01-09 vs 2011-12-09);
    ``total_days`` is the plain day difference.  ``ref`` defaults to the
    latest date in ``sales`` (else in ``base``), as a scalar subquery."""
    return base.select("customer_id", _date_diff(_ref_column(base, ref, sales), recency).alias("date_diff"))


def rfm_combined(base: DataFrame, recency: DataFrame | None = None, *, ref=None,
                 recency_kind: str = "age_day", sales: DataFrame | None = None) -> DataFrame:
    """customer_id, counts_freq, monetary, date_diff.  Given a recency
    table it is joined on customer_id; otherwise recency is computed in the
    same projection (no join: both come from one aggregate)."""
    if recency is not None:
        return base.join(recency, "customer_id").select("customer_id", "counts_freq", "monetary", "date_diff")
    dd = _date_diff(_ref_column(base, ref, sales), recency_kind)
    return base.select("customer_id", "counts_freq", "monetary", dd.alias("date_diff"))


def rfm_scores(combined: DataFrame, tiles: int = 5) -> DataFrame:
    """Quintile scores (most recent = 5; ties broken by customer_id) and
    the code 100R + 10F + M, sorted by code and customer (a code alone would
    put all its customers into one sort task)."""
    df = ntiles(combined, tiles, {"rfm_recency": ("date_diff", False), "rfm_freq": ("counts_freq", True),
                                  "rfm_monetary": ("monetary", True)}, "customer_id")
    code = F.col("rfm_recency") * 100 + F.col("rfm_freq") * 10 + F.col("rfm_monetary")
    return (df.select("customer_id", "rfm_recency", "rfm_freq", "rfm_monetary", "date_diff", "counts_freq",
                      "monetary", code.alias("rfm_combined")).orderBy(*_by_code()))


def segment_of(r, f, m):
    """The eleven-way CASE over the three scores."""
    expr = None
    for name, r_lo, r_hi, fm_lo, fm_hi in SEGMENTS:
        cond = r.between(r_lo, r_hi) & f.between(fm_lo, fm_hi) & m.between(fm_lo, fm_hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(OTHER_SEGMENT))


def rfm_segments(scores: DataFrame) -> DataFrame:
    """customer_id, rfm_combined, customer_segments."""
    r, f, m = F.col("rfm_recency"), F.col("rfm_freq"), F.col("rfm_monetary")
    return (scores.select("customer_id", (r * 100 + f * 10 + m).alias("rfm_combined"),
                          segment_of(r, f, m).alias("customer_segments")).orderBy(*_by_code()))


def _label(score, labels):
    return F.when(score == 1, labels[0]).when(score == 2, labels[1]).when(score == 3, labels[2])


def rfm_three_tier(base: DataFrame) -> DataFrame:
    """Tercile scores (recency ascending by last date, so the latest
    buyers score 3), code, and one label per score."""
    df = ntiles(base, 3, {"rfm_recency": ("most_recent_date", True), "rfm_freq": ("counts_freq", True),
                          "rfm_monetary": ("monetary", True)}, "customer_id")
    r, f, mo = F.col("rfm_recency"), F.col("rfm_freq"), F.col("rfm_monetary")
    return (df.select("customer_id", "counts_freq", "monetary", "rfm_recency", "rfm_freq", "rfm_monetary",
                      (r * 100 + f * 10 + mo).alias("rfm_combined"),
                      _label(r, RECENCY_LABELS).alias("recency_segment"),
                      _label(f, FREQUENCY_LABELS).alias("frequency_segment"),
                      _label(mo, MONETARY_LABELS).alias("monetary_segment"))
            .orderBy(*_by_code()))
