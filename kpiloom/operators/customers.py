"""Customer acquisition, activity and retention by month.

Each window below runs over one row per month (already aggregated).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions.dates import month_name, month_start, month_year_label
from kpiloom.functions.numeric import exact_round_div
from kpiloom.operators.common import since


def _registrations(sales: DataFrame, start, pairs: DataFrame | None = None) -> DataFrame:
    # First purchase since start per customer; the NULL customer forms a
    # group too, so a month holding only it shows 0.  After grouping by
    # customer each id appears once: count() equals count(distinct).
    # With (month, CustomerID) pairs the first month is the least month.
    if pairs is not None:
        reg = pairs.groupBy("CustomerID").agg(F.min("month").alias("_reg"))
    else:
        reg = since(sales, start).groupBy("CustomerID").agg(F.min("InvoiceDate").alias("_reg"))
    return reg.groupBy(month_start("_reg").alias("_m")).agg(F.count("CustomerID").alias("regs"))


def new_customers(sales: DataFrame, start=None, *, pairs: DataFrame | None = None) -> DataFrame:
    """Customers whose first purchase since ``start`` falls in each month."""
    return _registrations(sales, start, pairs).orderBy("_m").select(month_name("_m").alias("reg_month"), "regs")


def new_customers_cumulative(sales: DataFrame, start=None, *, pairs: DataFrame | None = None) -> DataFrame:
    """U1 with a running total in calendar order."""
    r = _registrations(sales, start, pairs)
    return r.orderBy("_m").select(
        month_name("_m").alias("reg_month"), "regs",
        F.sum("regs").over(Window.orderBy("_m")).cast("bigint").alias("customer_no_cumulative"))


def _monthly_active(sales: DataFrame, start, pairs: DataFrame | None = None) -> DataFrame:
    if pairs is not None:  # pairs are distinct: counting ids counts distinct ids
        return pairs.groupBy(F.col("month").alias("_m")).agg(F.count("CustomerID").alias("current_customer_count"))
    return (since(sales, start).groupBy(month_start("InvoiceDate").alias("_m"))
            .agg(F.countDistinct("CustomerID").alias("current_customer_count")))


def active_customers(sales: DataFrame, start=None, *, pairs: DataFrame | None = None) -> DataFrame:
    """Distinct customers per month and the previous month row's count (0 first)."""
    m = _monthly_active(sales, start, pairs)
    prev = F.coalesce(F.lag("current_customer_count").over(Window.orderBy("_m")), F.lit(0))
    return m.orderBy("_m").select(month_name("_m").alias("month"), "current_customer_count",
                                  prev.cast("bigint").alias("previous_customer_count"))


def active_customer_growth(sales: DataFrame, start=None, *, pairs: DataFrame | None = None) -> DataFrame:
    """U4: (current - previous) / previous, previous defaulting to 1; NULL when 0."""
    m = _monthly_active(sales, start, pairs)
    prev = F.coalesce(F.lag("current_customer_count").over(Window.orderBy("_m")), F.lit(1))
    m = m.withColumn("_prev", prev)
    rate = F.when(F.col("_prev") != 0, (F.col("current_customer_count") - F.col("_prev")).cast("double")
                  / F.col("_prev").cast("double"))
    return m.orderBy("_m").select("current_customer_count", month_year_label("_m").alias("month"),
                                  rate.alias("growth_rate"))


def retention(sales: DataFrame, start=None, *, pairs: DataFrame | None = None) -> DataFrame:
    """Share of a month's customers active again the next month, to 2 places,
    labelled by the earlier month (the last month is 0; NULL customers never
    count as returning).

    The reference LEFT JOINs the (month, customer) pairs to themselves shifted
    by a month.  Here the pairs are built once (one scan, partial aggregation)
    and ``lead`` over each customer's months finds the next active month: a
    window partitioned by customer holds at most one row per month, and no
    join or second scan of the fact table is needed.
    """
    if pairs is not None:
        act = pairs.select(F.col("month").alias("delivr_month"), F.col("CustomerID").alias("user_id"))
    else:
        act = since(sales, start).select(month_start("InvoiceDate").alias("delivr_month"),
                                         F.col("CustomerID").alias("user_id")).distinct()
    nxt = F.lead("delivr_month").over(Window.partitionBy("user_id").orderBy("delivr_month"))
    back = F.col("user_id").isNotNull() & (nxt == F.add_months("delivr_month", 1))
    return (act.withColumn("_back", back).groupBy("delivr_month")
            .agg(exact_round_div(F.count(F.when(F.col("_back"), 1)), F.greatest(F.count("user_id"), F.lit(1)), 2)
                 .alias("retention_rate"))
            .orderBy("delivr_month"))
