"""Customers bucketed by revenue and by number of orders."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.numeric import exact_round_div, round_to_double, trunc_toward_zero
from kpiloom.operators.common import since
from kpiloom.operators.economics import customer_revenues
from kpiloom.plans.bins import count_in_bins
from kpiloom.plans.intervals import count_in_intervals, interval_join
from kpiloom.plans.selection import exact_percentiles

# The reference's group labels and cut-offs.
REVENUE_GROUPS = ("Low-revenue users", "Mid-revenue users", "High-revenue users")
REVENUE_CUTS = (672, 672.1, 2110, 2110.1)  # low <= 672; 672.1 <= mid <= 2110; high >= 2110.1
ORDER_GROUPS = ("Low-orders users", "Mid-orders users", "High-orders users")
ORDER_CUTS = (3, 10)  # low <= 3; 3 < mid <= 10; high otherwise
REVENUE_BINS = (0, 350_000, 50_000)  # lower classes 0..300000, upper classes 50000..350000


def customer_orders(sales: DataFrame, start=None) -> DataFrame:
    """Per identified customer: customer_id, orders_count (distinct invoices)."""
    return (since(sales, start, customers_only=True).groupBy(F.col("CustomerID").alias("customer_id"))
            .agg(F.countDistinct("InvoiceNo").alias("orders_count")))


def _cr(sales: DataFrame, start, per_customer: DataFrame | None) -> DataFrame:
    # a precomputed per-customer table (see plans.report.customer_summary) or the aggregate
    if per_customer is not None:
        return per_customer.select("customer_id", "revenue")
    return customer_revenues(sales, start)


def _co(sales: DataFrame, start, per_customer: DataFrame | None) -> DataFrame:
    if per_customer is not None:
        return per_customer.select("customer_id", "orders_count")
    return customer_orders(sales, start)


def orders_histogram(sales: DataFrame, start=None, *, per_customer: DataFrame | None = None) -> DataFrame:
    """B1: how many customers placed each number of orders."""
    return (_co(sales, start, per_customer).groupBy(F.col("orders_count").alias("number_of_orders"))
            .agg(F.count("customer_id").alias("customer_number")).orderBy("number_of_orders"))


def revenue_classes(sales: DataFrame, start=None, width: int = 1000, *,
                    per_customer: DataFrame | None = None) -> DataFrame:
    """B2: customers per revenue truncated toward zero to a multiple of ``width``."""
    return (_cr(sales, start, per_customer)
            .groupBy(trunc_toward_zero("revenue", width).alias("revenue_category"))
            .agg(F.count("customer_id").alias("customers")).orderBy("revenue_category"))


def revenue_intervals(sales: DataFrame, start=None, lo: int = REVENUE_BINS[0], hi: int = REVENUE_BINS[1],
                      step: int = REVENUE_BINS[2], *, per_customer: DataFrame | None = None) -> DataFrame:
    """Customers per closed revenue interval; empty intervals show 0."""
    return count_in_bins(_cr(sales, start, per_customer), "revenue", lo, hi, step,
                         "customer_number").orderBy("lower_class")


def revenue_intervals_of(sales: DataFrame, intervals: DataFrame, start=None, *, per_customer: DataFrame | None = None) -> DataFrame:
    """B3 on any intervals (lower_class, upper_class): uneven, overlapping, gapped; NULL is an open end."""
    return count_in_intervals(_cr(sales, start, per_customer), "revenue", intervals, "lower_class", "upper_class",
                              "customer_number").orderBy(F.asc_nulls_first("lower_class"), F.asc_nulls_last("upper_class"))


def revenue_groups_by_join(sales: DataFrame, groups: DataFrame, start=None, *, per_customer: DataFrame | None = None) -> DataFrame:
    """B5 with its cut-offs in a table (revenue_group, lower, upper): a left join of customers to intervals.

    Customers in no interval form the NULL group; one in several counts in each."""
    joined = interval_join(_cr(sales, start, per_customer).select("customer_id", "revenue"), "revenue", groups, "lower", "upper", "left")
    return joined.groupBy("revenue_group").agg(F.count("customer_id").alias("customers")).orderBy(F.desc("customers"))


def revenue_distribution(sales: DataFrame, start=None, approx: bool = False, *, per_customer: DataFrame | None = None) -> DataFrame:
    """Min, median (percentile_cont), mean, max of customer revenue, 2 places.

    Exact by default (order statistics, no single-reducer value map);
    ``approx=True`` uses percentile_approx, which returns a sample value.
    """
    cr = _cr(sales, start, per_customer)
    r = F.col("revenue")
    others = [F.min(r).alias("_min"), exact_round_div(F.sum(r), F.count(r), 2).alias("avg_revenue"),
              F.max(r).alias("_max")]
    if approx:
        out = cr.agg(F.percentile_approx(r, 0.5, 10_000).alias("_med"), *others)
    else:
        out = exact_percentiles(cr, "revenue", {"_med": 0.5}, extra_aggs=others)
    return out.select(round_to_double("_min", 2).alias("min_revenue"),
                      round_to_double("_med", 2).alias("median_revenue"),
                      "avg_revenue", round_to_double("_max", 2).alias("max_revenue"))


def revenue_groups(sales: DataFrame, start=None, cuts: Sequence[float] = REVENUE_CUTS,
                   labels: Sequence[str] = REVENUE_GROUPS, *, per_customer: DataFrame | None = None) -> DataFrame:
    """Low / mid / high revenue customers.  Values between the cut-offs
    (e.g. 672.05) match no branch and form the NULL group, as written."""
    c = [F.lit(Decimal(str(x))) for x in cuts]
    r = F.col("revenue")
    grp = (F.when(r <= c[0], labels[0]).when((r >= c[1]) & (r <= c[2]), labels[1])
           .when(r >= c[3], labels[2]))
    return (_cr(sales, start, per_customer).groupBy(grp.alias("revenue_group"))
            .agg(F.count("customer_id").alias("customers")).orderBy(F.desc("customers")))


def orders_distribution(sales: DataFrame, start=None, approx: bool = False, *,
                        per_customer: DataFrame | None = None) -> DataFrame:
    """Min, median, 75th percentile, mean, max of orders per customer.

    Exact ``percentile`` is safe here: it keeps one entry per distinct order
    count, and map-side partial aggregation merges them, so its memory is
    bounded by the largest order count, not by the number of customers.
    ``approx=True`` uses percentile_approx (sample values, no interpolation).
    """
    o = F.col("orders_count")
    if approx:
        med, p75 = F.percentile_approx(o, 0.5, 10_000), F.percentile_approx(o, 0.75, 10_000)
    else:
        med, p75 = F.percentile(o, 0.5), F.percentile(o, 0.75)
    return _co(sales, start, per_customer).agg(
        F.round(F.min(o), 2).cast("double").alias("min_count"),
        F.round(med, 2).cast("double").alias("median_count"),
        F.round(p75, 2).cast("double").alias("seventyfive_percentile_count"),
        exact_round_div(F.sum(o), F.count(o), 2).alias("avg_count"),
        F.round(F.max(o), 2).cast("double").alias("max_count"))


def order_groups(sales: DataFrame, start=None, cuts: Sequence[int] = ORDER_CUTS,
                 labels: Sequence[str] = ORDER_GROUPS, *, per_customer: DataFrame | None = None) -> DataFrame:
    """Low / mid / high order-count customers."""
    o = F.col("orders_count")
    grp = F.when(o <= cuts[0], labels[0]).when((o > cuts[0]) & (o <= cuts[1]), labels[1]).otherwise(labels[2])
    return (_co(sales, start, per_customer).groupBy(grp.alias("order_number_group"))
            .agg(F.count("customer_id").alias("customers")).orderBy(F.desc("customers")))
