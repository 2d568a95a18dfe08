"""The whole retail report as one job, with shared work done once.

Run one by one, the analyses scan and aggregate the fact table again and
again.  ``retail_report`` builds three shared tables once, each written as
a reliable checkpoint:

- a per-customer summary (revenue, distinct invoices, last purchase date,
  distinct purchase days) for the 14 per-customer analyses K1, B1-B7, R1-R6;
- (month, customer) pairs with their revenue for U1-U5 and K2;
- revenue per (day, country), bounded by the calendar and the country list
  at any scale, for the 7 time-based revenue entries V6-V11.

V2-V5 reuse V1; the rest read the table as usual.  Results equal the
registered queries one for one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.dates import month_start
from kpiloom.operators import buckets, customers, economics, profile, revenue, rfm
from kpiloom.operators.common import since
from kpiloom.session import reliable_checkpoint


def customer_summary(sales: DataFrame, start=None) -> DataFrame:
    """One row per identified customer: revenue, orders_count, most_recent_date,
    counts_freq.  Lines collapse to (customer, day, invoice) first, so the
    two distinct counts work on those few rows, not on every line."""
    parts = (since(sales, start, customers_only=True)
             .groupBy("CustomerID", "InvoiceDate", "InvoiceNo").agg(F.sum("rev").alias("_r")))
    return parts.groupBy(F.col("CustomerID").alias("customer_id")).agg(
        F.sum("_r").cast("decimal(28,8)").alias("revenue"),
        F.countDistinct("InvoiceNo").alias("orders_count"),
        F.max("InvoiceDate").alias("most_recent_date"),
        F.countDistinct("InvoiceDate").alias("counts_freq"))


def month_customer_pairs(sales: DataFrame, start=None) -> DataFrame:
    """One row per (month, CustomerID) with activity since ``start``, NULL
    customer included, with the pair's revenue.  Monthly revenue, active and
    new customers, retention and revenue per customer all derive from it."""
    return (since(sales, start).groupBy(month_start("InvoiceDate").alias("month"), "CustomerID")
            .agg(F.sum("rev").alias("revenue")))


def daily_country_revenue(sales: DataFrame) -> DataFrame:
    """Revenue per (InvoiceDate, Country): at most days x countries rows,
    however large the table.  It has the ``InvoiceDate``, ``Country`` and
    ``rev`` columns the time-based revenue analyses (V6-V11) read, and a sum
    of sums is the same sum, so they run on it unchanged."""
    return sales.groupBy("InvoiceDate", "Country").agg(F.sum("rev").alias("rev"))


def retail_report(sales: DataFrame, start=None, *, quarters: Sequence[str] | None = None,
                  bins: Sequence[int] = buckets.REVENUE_BINS, revenue_cuts: Sequence[float] = buckets.REVENUE_CUTS,
                  order_cuts: Sequence[int] = buckets.ORDER_CUTS, class_width: int = 1000,
                  top_items: int = 20, top_countries: int = 10, top_per_month: int = 5) -> dict[str, DataFrame]:
    """Every retail analysis (F2-F4, V1-V12, U1-U5, K1-K4, B1-B7, R1-R6) by registry name."""
    summary = reliable_checkpoint(customer_summary(sales, start))
    pc = {"per_customer": summary}
    mp = {"pairs": reliable_checkpoint(month_customer_pairs(sales, start))}
    daily = reliable_checkpoint(daily_country_revenue(sales))
    v1 = revenue.item_country_revenue(sales, start)
    base = rfm.rfm_base(sales, start, **pc)
    comb = rfm.rfm_combined(base, sales=sales)
    scores = rfm.rfm_scores(comb)
    return {
        "F2_non_null_counts": profile.non_null_counts(sales),
        "F3_distinct_counts": profile.distinct_counts(sales, start),
        "F4_row_count": profile.row_count(sales),
        "V1_item_country_revenue": v1,
        "V2_item_revenue": revenue.item_revenue(v1),
        "V3_top_items": revenue.top_items(v1, top_items),
        "V4_country_revenue": revenue.country_revenue(v1),
        "V5_top_countries": revenue.top_countries(v1, top_countries),
        "V6_weekly_revenue": revenue.weekly_revenue(daily, start),
        "V7_avg_monthly_revenue": revenue.avg_monthly_revenue(daily, start),
        "V8_monthly_revenue": revenue.monthly_revenue(daily, start),
        "V9_quarterly_revenue": revenue.quarterly_revenue(daily, start),
        "V10_quarterly_by_country": revenue.quarterly_revenue_by_country(daily, start, quarters),
        "V10_quarterly_by_country_dense": revenue.quarterly_revenue_by_country(daily, start, quarters, dense=True),
        "V11_monthly_growth": revenue.monthly_growth(daily, start),
        "V12_top_items_per_month": revenue.top_items_per_month(sales, start, top_per_month),
        "U1_new_customers": customers.new_customers(sales, start, **mp),
        "U2_new_customers_cumulative": customers.new_customers_cumulative(sales, start, **mp),
        "U3_active_customers": customers.active_customers(sales, start, **mp),
        "U4_active_customer_growth": customers.active_customer_growth(sales, start, **mp),
        "U5_retention": customers.retention(sales, start, **mp),
        "K1_avg_revenue_per_customer": economics.avg_revenue_per_customer(sales, start, **pc),
        "K2_avg_revenue_per_customer_by_month": economics.avg_revenue_per_customer_by_month(sales, start, **mp),
        "K3_country_customers": economics.country_customers(sales, start),
        "K4_avg_revenue_per_customer_by_country": economics.avg_revenue_per_customer_by_country(sales, start),
        "B1_orders_histogram": buckets.orders_histogram(sales, start, **pc),
        "B2_revenue_classes": buckets.revenue_classes(sales, start, class_width, **pc),
        "B3_revenue_intervals": buckets.revenue_intervals(sales, start, *bins, **pc),
        "B4_revenue_distribution": buckets.revenue_distribution(sales, start, **pc),
        "B5_revenue_groups": buckets.revenue_groups(sales, start, revenue_cuts, **pc),
        "B6_orders_distribution": buckets.orders_distribution(sales, start, **pc),
        "B7_order_groups": buckets.order_groups(sales, start, order_cuts, **pc),
        "R1_rfm_base": base,
        "R2_rfm_recency": rfm.rfm_recency(base, sales=sales),
        "R3_rfm_combined": comb,
        "R4_rfm_scores": scores,
        "R5_rfm_segments": rfm.rfm_segments(scores),
        "R6_rfm_three_tier": rfm.rfm_three_tier(base),
    }
