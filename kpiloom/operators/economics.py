"""K1-K4: unit economics (identified customers only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.dates import month_start, month_year_label
from kpiloom.functions.numeric import exact_round_div
from kpiloom.operators.common import since
from kpiloom.operators.revenue import UNSPECIFIED


def customer_revenues(sales: DataFrame, start=None) -> DataFrame:
    """Per identified customer: customer_id, revenue (decimal).  Shared by K1, B2-B5."""
    return (since(sales, start, customers_only=True).groupBy(F.col("CustomerID").alias("customer_id"))
            .agg(F.sum("rev").alias("revenue")))


def avg_revenue_per_customer(sales: DataFrame, start=None, *, per_customer: DataFrame | None = None) -> DataFrame:
    """K1: mean revenue per customer, to 2 places."""
    cr = customer_revenues(sales, start) if per_customer is None else per_customer
    return cr.agg(
        exact_round_div(F.sum("revenue"), F.count("revenue"), 2).alias("avg_revenue_per_customer"))


def _per_customer_then(sales: DataFrame, start, key) -> DataFrame:
    """sum(rev) and count(distinct CustomerID) per ``key`` as two plain
    aggregations: per (key, customer) first, then per key.  Exact (customers
    are not NULL here) and, unlike a distinct aggregate next to a sum, needs
    no Expand that doubles every row before the shuffle."""
    pairs = (since(sales, start, customers_only=True)
             .groupBy(key.alias("_k"), "CustomerID").agg(F.sum("rev").alias("_cust_rev")))
    return pairs.groupBy("_k").agg(F.sum("_cust_rev").alias("_rev"), F.count("CustomerID").alias("_users"))


def avg_revenue_per_customer_by_month(sales: DataFrame, start=None, *,
                                      pairs: DataFrame | None = None) -> DataFrame:
    """K2: month revenue / distinct customers that month (ratio of totals)."""
    if pairs is not None:
        m = (pairs.where(F.col("CustomerID").isNotNull()).groupBy(F.col("month").alias("_m"))
             .agg(F.sum("revenue").alias("_rev"), F.count("CustomerID").alias("_users")))
    else:
        m = _per_customer_then(sales, start, month_start("InvoiceDate")).withColumnRenamed("_k", "_m")
    return m.orderBy("_m").select(
        month_year_label("_m").alias("month"),
        exact_round_div("_rev", F.greatest(F.col("_users"), F.lit(1)), 2).alias("avg_revenue_customer"))


def _by_country(sales: DataFrame, start) -> DataFrame:
    c = _per_customer_then(sales.where(~F.col("Country").like(UNSPECIFIED)), start, F.col("Country"))
    return c.select(F.col("_k").alias("country"), F.round("_rev", 2).alias("_rev"),
                    F.col("_users").alias("customers"))


def country_customers(sales: DataFrame, start=None) -> DataFrame:
    """K3: revenue (2 places) and distinct customers per country, 'Unspecified' excluded."""
    return (_by_country(sales, start).orderBy(F.desc("customers"))
            .select("country", F.col("_rev").cast("double").alias("revenue"), "customers"))


def avg_revenue_per_customer_by_country(sales: DataFrame, start=None) -> DataFrame:
    """K4: K3's rounded revenue / customers, to 2 places."""
    c = _by_country(sales, start)
    ratio = exact_round_div("_rev", F.greatest(F.col("customers"), F.lit(1)), 2)
    return (c.select(F.trim("country").alias("country_name"), F.col("_rev").cast("double").alias("revenue_country"),
                     F.col("customers").alias("customer_number"), ratio.alias("avg_rev_cust_country"))
            .orderBy(F.desc("avg_rev_cust_country")))

