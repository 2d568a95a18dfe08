"""The registered analyses: name -> callable(spark, sf_dir) -> DataFrame.

Every entry reads the given tables (through the adapters) over their whole
extent, with the cut-off at the first order date; the analyses with a cut-off
are registered a second time from 2001 on (``..._2001``), where it filters.
Parameters that the reference tuned to its own data (bins, cut-offs) are
rescaled to this data's per-customer revenue range.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.operators import (buckets, cleaning, customers, economics, experiment, profile,
                               revenue, rfm)
from kpiloom.operators.logit import logit_model
from kpiloom.sources import profiled, updates
from kpiloom.sources.files import load_sales, load_visits
from kpiloom.sources.infer import infer_types, load_csv, text_columns
from kpiloom.sources.store import cleaned_path, cleaned_sales, csv_copy, pinned_visits, session_folder, visits_path
from kpiloom.sources.tables import sales_from_tables, visits_from_events

# The reference's experiment design.  Current and target
# share conversion, treatment share, number of looks, one-sided Pocock bound
# for 3 looks at alpha 0.05, the lift of the follow-up (+5 points), and the
# revenue class width.
DESIGN_P1, DESIGN_P2, DESIGN_SHARE = 0.032, 0.082, 0.5
LOOKS = 3
LONG_N = 5000            # visits per variant of the long sequential design
LIFT = 0.05
CLASS_WIDTH = 1000

# Parameters for this data (see README: registered parameters): the two cut-offs
# (all rows; the last year only) with bins that cover every customer's revenue,
# group cut-offs near the terciles, and the year whose quarters V10 shows.
# Uneven intervals of B3: open ends, an overlap, a single point, a gap, an empty one.
UNEVEN = ((None, 0), (0, 100_000), (100_000, 350_000), (250_000, 650_000.5), (580_000, 580_000), (700_000, 1_200_000),
          (1_500_000, 1_400_000), (1_300_000, None))


@dataclass(frozen=True)
class Scope:
    start: dt.date
    bins: tuple
    cuts: tuple
    year: int


ALL = Scope(dt.date(1995, 1, 1), (0, 3_000_000, 300_000), (580_000, 580_000.1, 1_000_000, 1_000_000.1), 1995)
RECENT = Scope(dt.date(2001, 1, 1), (-300_000, 900_000, 100_000), (70_000, 70_000.1, 150_000, 150_000.1), 2001)
START, REV_BINS, REV_CUTS, QUARTER_YEAR = ALL.start, ALL.bins, ALL.cuts, ALL.year
TEXT_DATE_FORMAT = "M/d/yyyy H:mm"  # InvoiceDate text as in the retail CSV, e.g. 12/1/2010 8:26
SEQ_N_PER_GROUP = experiment.sample_size_formula(DESIGN_P1, DESIGN_P2, DESIGN_SHARE) / 2  # 336.5
DIGITS = 9      # rounding of means and model outputs (floating results)
TEST_DIGITS = 6  # rounding of t statistics, degrees of freedom and p-values

Query = Callable[[SparkSession, str], DataFrame]


def _sales(spark, d):
    return cleaned_sales(spark, d)


def _visits(spark, d):
    pinned = pinned_visits(spark, d)
    return visits_from_events(spark, d) if pinned is None else pinned


def _raw_text_dates(spark, d):
    raw = sales_from_tables(spark, d)
    return raw.withColumn("InvoiceDate", F.date_format(F.col("InvoiceDate").cast("timestamp_ntz"),
                                                       TEXT_DATE_FORMAT))


def _load_sales(spark, d):
    """The retail view written as CSV once (dates as text) and read by the loader."""
    path = csv_copy(spark, d, "sales", lambda: _raw_text_dates(spark, d))
    return cleaning.parse_date(load_sales(spark, path), "InvoiceDate", TEXT_DATE_FORMAT)


def _visits_csv(spark, d):
    return csv_copy(spark, d, "visits", lambda: _visits(spark, d).drop("ts", "event_id"))


def _load_visits(spark, d):
    return load_visits(spark, _visits_csv(spark, d))


def _inferred_sales(spark, d):
    return csv_copy(spark, d, "sales", lambda: _raw_text_dates(spark, d))


def _quoted_lines(spark, d):
    """The retail view with line breaks and quotes inside its descriptions, written as CSV and read in splits."""
    def broken():
        name = F.concat("Description", F.lit('\n"'), "StockCode", F.lit('",\nback'))
        return _raw_text_dates(spark, d).withColumn("Description", name)
    rows = load_sales(spark, csv_copy(spark, d, "broken", broken), multi_line=True)
    return cleaning.parse_date(rows, "InvoiceDate", TEXT_DATE_FORMAT)


def _uneven(spark):
    rows = [tuple(None if x is None else Decimal(str(x)) for x in r) for r in UNEVEN]
    return spark.createDataFrame(rows, "lower_class decimal(18,4), upper_class decimal(18,4)")


def _groups(spark, cuts):
    c = [Decimal(str(x)) for x in cuts]
    low, mid, high = buckets.REVENUE_GROUPS
    return spark.createDataFrame([(low, None, c[0]), (mid, c[1], c[2]), (high, c[3], None)],
                                 "revenue_group string, lower decimal(18,4), upper decimal(18,4)")


def _uneven_intervals(spark, d, start):
    out = buckets.revenue_intervals_of(_sales(spark, d), _uneven(spark), start)
    return out.select(F.col("lower_class").cast("double").alias("lower_class"), F.col("upper_class").cast("double").alias("upper_class"),
                      "customer_number")


def _corrected(spark, d, changes, where, raw):
    """The retail view stored as a table of years, corrected in place."""
    root = session_folder(spark, "updated")
    updates.create_table(raw.withColumn("InvoiceYear", F.year("InvoiceDate")), root, "InvoiceYear", "InvoiceDate",
                         rebalance=False)
    for change, condition in zip(changes, where):
        updates.update_table(spark, root, change, condition)
    return updates.read_version(spark, root).drop("InvoiceYear")


def _normalised_in_place(spark, d):
    cols = ("Description", "Country")
    return _corrected(spark, d, [{c: cleaning.normalised(c)} for c in cols],
                      [cleaning.unnormalised(c) for c in cols], sales_from_tables(spark, d))


def _filled_in_place(spark, d):
    return _corrected(spark, d, [{"Description": F.lit(cleaning.NOT_AVAILABLE)}], [F.col("Description") == ""],
                      sales_from_tables(spark, d, clean_text="normalise"))


def _retail(p: Scope) -> dict[str, Query]:
    """The analyses with a date cut-off."""
    quarters = [f"Q{i} {p.year}" for i in range(1, 5)]
    v1 = lambda s, d: revenue.item_country_revenue(_sales(s, d), p.start, with_rank=False, exact=True)
    base = lambda s, d: rfm.rfm_base(_sales(s, d), p.start)
    comb = lambda s, d: rfm.rfm_combined(base(s, d), sales=_sales(s, d))
    return {
        "F3_distinct_counts": lambda s, d: profile.distinct_counts(_sales(s, d), p.start),
        "V1_item_country_revenue": lambda s, d: revenue.item_country_revenue(_sales(s, d), p.start),
        "V2_item_revenue": lambda s, d: revenue.item_revenue(v1(s, d)),
        "V3_top_items": lambda s, d: revenue.top_items(v1(s, d), 20),
        "V4_country_revenue": lambda s, d: revenue.country_revenue(v1(s, d)),
        "V5_top_countries": lambda s, d: revenue.top_countries(v1(s, d), 10),
        "V6_weekly_revenue": lambda s, d: revenue.weekly_revenue(_sales(s, d), p.start),
        "V7_avg_monthly_revenue": lambda s, d: revenue.avg_monthly_revenue(_sales(s, d), p.start),
        "V8_monthly_revenue": lambda s, d: revenue.monthly_revenue(_sales(s, d), p.start),
        "V9_quarterly_revenue": lambda s, d: revenue.quarterly_revenue(_sales(s, d), p.start),
        "V10_quarterly_by_country": lambda s, d: revenue.quarterly_revenue_by_country(_sales(s, d), p.start, quarters),
        "V10_quarterly_by_country_dense": lambda s, d: revenue.quarterly_revenue_by_country(
            _sales(s, d), p.start, quarters, dense=True),
        "V11_monthly_growth": lambda s, d: revenue.monthly_growth(_sales(s, d), p.start),
        "V12_top_items_per_month": lambda s, d: revenue.top_items_per_month(_sales(s, d), p.start, 5),
        "U1_new_customers": lambda s, d: customers.new_customers(_sales(s, d), p.start),
        "U2_new_customers_cumulative": lambda s, d: customers.new_customers_cumulative(_sales(s, d), p.start),
        "U3_active_customers": lambda s, d: customers.active_customers(_sales(s, d), p.start),
        "U4_active_customer_growth": lambda s, d: customers.active_customer_growth(_sales(s, d), p.start),
        "U5_retention": lambda s, d: customers.retention(_sales(s, d), p.start),
        "K1_avg_revenue_per_customer": lambda s, d: economics.avg_revenue_per_customer(_sales(s, d), p.start),
        "K2_avg_revenue_per_customer_by_month": lambda s, d: economics.avg_revenue_per_customer_by_month(
            _sales(s, d), p.start),
        "K3_country_customers": lambda s, d: economics.country_customers(_sales(s, d), p.start),
        "K4_avg_revenue_per_customer_by_country": lambda s, d: economics.avg_revenue_per_customer_by_country(
            _sales(s, d), p.start),
        "B1_orders_histogram": lambda s, d: buckets.orders_histogram(_sales(s, d), p.start),
        "B2_revenue_classes": lambda s, d: buckets.revenue_classes(_sales(s, d), p.start, CLASS_WIDTH),
        "B3_revenue_intervals": lambda s, d: buckets.revenue_intervals(_sales(s, d), p.start, *p.bins),
        "B3_uneven_intervals": lambda s, d: _uneven_intervals(s, d, p.start),
        "B4_revenue_distribution": lambda s, d: buckets.revenue_distribution(_sales(s, d), p.start),
        "B5_revenue_groups": lambda s, d: buckets.revenue_groups(_sales(s, d), p.start, p.cuts),
        "B5_revenue_groups_join": lambda s, d: buckets.revenue_groups_by_join(_sales(s, d), _groups(s, p.cuts), p.start),
        "B6_orders_distribution": lambda s, d: buckets.orders_distribution(_sales(s, d), p.start),
        "B7_order_groups": lambda s, d: buckets.order_groups(_sales(s, d), p.start),
        "R1_rfm_base": base,
        "R2_rfm_recency": lambda s, d: rfm.rfm_recency(base(s, d), sales=_sales(s, d)),
        "R3_rfm_combined": comb,
        "R4_rfm_scores": lambda s, d: rfm.rfm_scores(comb(s, d)),
        "R5_rfm_segments": lambda s, d: rfm.rfm_segments(rfm.rfm_scores(comb(s, d))),
        "R6_rfm_three_tier": lambda s, d: rfm.rfm_three_tier(base(s, d)),
    }


# the entries registered with the later cut-off as well
WITH_RECENT = ("V1_", "V6_", "V9_", "V10_", "V11_", "U", "K", "B", "R")


QUERIES: dict[str, Query] = {
    # ingest and cleaning
    "S1_load_sales": _load_sales,
    "S1_inferred_types": lambda s, d: infer_types(text_columns(s, _inferred_sales(s, d))),
    "S1_inferred_load": lambda s, d: load_csv(s, _inferred_sales(s, d), dates=True),
    "S1_quoted_line_breaks": _quoted_lines,
    "S2_load_visits": _load_visits,
    "S2_inferred_load": lambda s, d: load_csv(s, _visits_csv(s, d)),
    # any ten rows will do; a total order makes the result comparable
    "S3_sample_rows": lambda s, d: cleaning.sample_rows(
        _sales(s, d).drop("InvoiceYear", "rev"), 10, order=["InvoiceDate", "InvoiceNo", "StockCode", "Quantity"]),
    "C1_normalise_text": lambda s, d: cleaning.normalise_text(sales_from_tables(s, d), dictionary=True),
    "C2_fill_empty": lambda s, d: cleaning.fill_empty(cleaning.normalise_text(sales_from_tables(s, d), dictionary=True)),
    "C1_update_in_place": _normalised_in_place,
    "C2_update_in_place": _filled_in_place,
    "C3_parse_date": lambda s, d: cleaning.parse_date(_raw_text_dates(s, d), "InvoiceDate", TEXT_DATE_FORMAT),
    # profiling
    "F2_non_null_counts": lambda s, d: profile.non_null_counts(_sales(s, d)),
    "F4_row_count": lambda s, d: profile.row_count(_sales(s, d)),
    "F5_date_range": lambda s, d: profile.date_range(_visits(s, d), "visit_date"),
    "F2_from_write": lambda s, d: profiled.non_null_counts(s, cleaned_path(s, d)),
    "F4_from_write": lambda s, d: profiled.row_count(s, cleaned_path(s, d)),
    "F5_from_write": lambda s, d: profiled.date_range(s, visits_path(s, d, lambda: _visits(s, d))),
    **_retail(ALL),
    **{f"{name}_{RECENT.year}": q for name, q in _retail(RECENT).items() if name.startswith(WITH_RECENT)},
    # experiment
    "X1_conversion_rates": lambda s, d: experiment.conversion_rates(_visits(s, d)),
    "X2_conversion_crosstab": lambda s, d: experiment.conversion_crosstab(_visits(s, d)),
    "X3_weekly_conversion": lambda s, d: experiment.weekly_conversion(_visits(s, d)),
    "X4_logit_test": lambda s, d: experiment.logit_test(_visits(s, d), "clicked_like", with_p=False,
                                                        digits=DIGITS),
    "X4_logit_test_p": lambda s, d: experiment.logit_test(_visits(s, d), "clicked_like", digits=TEST_DIGITS),
    "X4_logit_test_share": lambda s, d: experiment.logit_test(_visits(s, d), "clicked_share", digits=TEST_DIGITS),
    "X4_logit_levels": lambda s, d: logit_model(_visits(s, d).withColumn(
        "third", F.floor((F.dayofmonth("visit_date") - 1) / 10)), "clicked_like", ["third"], with_p=False, digits=TEST_DIGITS),
    "X4_logit_factors": lambda s, d: logit_model(
        _visits(s, d).withColumn("late", F.when(F.dayofmonth("visit_date") > 10, "yes").otherwise("no")), "clicked_like",
        ["condition", "late"], with_p=False, digits=TEST_DIGITS),
    "X5_sample_size": lambda s, d: experiment.sample_size(_visits(s, d), "clicked_share", LIFT),
    "X6_sequential_looks": lambda s, d: experiment.sequential_looks(
        _visits(s, d), "clicked_like", SEQ_N_PER_GROUP, LOOKS, digits=DIGITS),
    "X6_sequential_looks_5000": lambda s, d: experiment.sequential_looks(
        _visits(s, d), "clicked_like", LONG_N, LOOKS, digits=DIGITS),
    "X7_mean_time": lambda s, d: experiment.mean_time(_visits(s, d), True, digits=DIGITS),
    "X8_weekly_time": lambda s, d: experiment.weekly_time(_visits(s, d), digits=DIGITS),
    "X9_welch_test": lambda s, d: experiment.welch_test(_visits(s, d), with_p=False, digits=TEST_DIGITS),
    "X9_welch_test_p": lambda s, d: experiment.welch_test(_visits(s, d), digits=TEST_DIGITS),
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)
