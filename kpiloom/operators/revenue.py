"""Revenue by item, country, week, month and quarter.

Sums are over the decimal line revenue ``rev``; rounding happens on the
decimal, and only the output is cast to double.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions.dates import (month_name, month_start, month_year_label, quarter_label,
                                     week_start, year_start_on_or_after)
from kpiloom.functions.numeric import exact_round_div, round_to_double
from kpiloom.functions.text import pg_initcap
from kpiloom.operators.common import _d, since, since_year_of
from kpiloom.plans.selection import dense_rank
from kpiloom.plans.topk import top_k_distinct_per_group

UNSPECIFIED = "Unspecified"  # fixed value: the country label excluded by V4 and K3/K4


def item_country_revenue(sales: DataFrame, start=None, with_rank: bool = True, exact: bool = False) -> DataFrame:
    """V1: revenue per (Description, Country) of identified customers, with a
    dense rank over all pairs by unrounded revenue.  The displayed name is
    initcap'ed again.  V2-V5 read only names and revenue: ``with_rank=False``
    skips the ranking for them and ``exact=True`` keeps the revenue a decimal."""
    g = (since(sales, start, customers_only=True)
         .groupBy("Description", "Country").agg(F.sum("rev").alias("_rev")))
    revenue = F.round("_rev", 3) if exact else round_to_double("_rev", 3)
    cols = [pg_initcap("Description").alias("item_description"), F.col("Country").alias("country"),
            revenue.alias("revenue")]
    if not with_rank:
        return g.select(*cols)
    return dense_rank(g, "_rev", out="item_rank").select("item_rank", *cols)


def item_revenue(v1: DataFrame) -> DataFrame:
    """V2: the V1 rows as (items, revenue), largest first (NULL before all, as PostgreSQL sorts)."""
    return (v1.select(F.col("item_description").alias("items"), F.col("revenue").cast("double").alias("revenue"))
            .orderBy(F.desc_nulls_first("revenue"), F.asc_nulls_last("items")))


def top_items(v1: DataFrame, n: int = 20) -> DataFrame:
    """V3: the n largest V1 rows; ties broken by name then country."""
    return (v1.orderBy(F.desc_nulls_first("revenue"), F.asc_nulls_last("item_description"), F.asc_nulls_last("country"))
            .limit(n).select(F.col("item_description").alias("items"), F.col("revenue").cast("double").alias("revenue")))


def _country_sums(v1: DataFrame) -> DataFrame:
    # exact V1 revenue is a decimal already; the three-place double of a plain V1 casts back
    return v1.groupBy("country").agg(F.sum(F.col("revenue").cast("decimal(28,3)")).alias("_s"))


def country_revenue(v1: DataFrame) -> DataFrame:
    """V4: V1 summed by country (without 'Unspecified'), dense-ranked; one row
    per country, so the ranking window holds at most the number of countries."""
    s = _country_sums(v1.where(F.col("country") != UNSPECIFIED))
    w = Window.orderBy(F.desc_nulls_first("_s"))
    return (s.select(F.dense_rank().over(w).cast("bigint").alias("country_rank"), "country",
                     round_to_double("_s", 2).alias("revenue"), "_s")
            .orderBy(F.desc_nulls_first("_s"), F.asc_nulls_last("country")).drop("_s"))


def top_countries(v1: DataFrame, n: int = 10) -> DataFrame:
    """V5: the n countries with most V1 revenue ('Unspecified' kept), unrounded sums."""
    s = _country_sums(v1)
    w = Window.orderBy(F.desc_nulls_first("_s"))
    return (s.select(F.dense_rank().over(w).cast("bigint").alias("country_rank"), "country",
                     F.col("_s").cast("double").alias("revenue"), "_s")
            .orderBy(F.desc_nulls_first("_s"), F.asc_nulls_last("country")).limit(n).drop("_s"))


def weekly_revenue(sales: DataFrame, start=None) -> DataFrame:
    """V6: revenue per Monday-starting week, all rows from the year of ``start``."""
    return (since_year_of(sales, start).groupBy(week_start("InvoiceDate").alias("delivr_week"))
            .agg(round_to_double(F.sum("rev"), 3).alias("revenue")).orderBy("delivr_week"))


def _monthly(sales: DataFrame, start, customers_only=False, pairs: DataFrame | None = None) -> DataFrame:
    if pairs is not None:  # (month, CustomerID, revenue) from plans.report.month_customer_pairs
        src = pairs.where(F.col("CustomerID").isNotNull()) if customers_only else pairs
        return src.groupBy(F.col("month").alias("_m")).agg(F.round(F.sum("revenue"), 3).alias("_rev"))
    return (since(sales, start, customers_only).groupBy(month_start("InvoiceDate").alias("_m"))
            .agg(F.round(F.sum("rev"), 3).alias("_rev")))


def avg_monthly_revenue(sales: DataFrame, start=None, *, pairs: DataFrame | None = None) -> DataFrame:
    """V7: mean over the months present of the month's rounded revenue, to 2 places."""
    m = _monthly(sales, start, pairs=pairs)
    return m.agg(exact_round_div(F.sum(F.coalesce("_rev", F.lit(0))), F.count(F.lit(1)), 2)
                 .alias("avg_monthly_revenue"))


def monthly_revenue(sales: DataFrame, start=None, *, pairs: DataFrame | None = None) -> DataFrame:
    """V8: revenue per month with the unpadded month name, in calendar order."""
    m = _monthly(sales, start, pairs=pairs)
    return m.orderBy("_m").select(month_name("_m").alias("months"),
                                  F.col("_rev").cast("double").alias("revenue"))


def quarterly_revenue(sales: DataFrame, start=None) -> DataFrame:
    """V9: revenue per 'Qn YYYY' label, keeping labels whose rounded revenue is > 0."""
    q = (since_year_of(sales, start).groupBy(quarter_label("InvoiceDate").alias("deliver_quarter"))
         .agg(F.round(F.sum("rev"), 3).alias("_rev")))
    return (q.where(F.col("_rev") > 0).orderBy("deliver_quarter")
            .select("deliver_quarter", F.col("_rev").cast("double").alias("revenue")))


def quarterly_revenue_by_country(sales: DataFrame, start=None, quarters: Sequence[str] | None = None,
                                 dense: bool = False) -> DataFrame:
    """Quarter revenue as columns quarter_1..quarter_k.

    As written, the outer query groups by (quarter, country), so there is one
    row per pair with only its own quarter's column filled; that is the
    default.  ``dense=True`` gives one row per country (a pivot).
    """
    if quarters is None:
        year = year_start_on_or_after(_d(start)).year if start is not None else None
        if year is None:
            raise ValueError("give quarters or start")
        quarters = [f"Q{i} {year}" for i in range(1, 5)]
    inner = (since_year_of(sales, start)
             .groupBy(F.col("Country").alias("country"), quarter_label("InvoiceDate").alias("deliver_quarter"))
             .agg(F.round(F.sum("rev"), 3).alias("_rev")).where(F.col("_rev") > 0))
    cells = [F.when(F.col("deliver_quarter") == q, F.col("_rev")) for q in quarters]
    if dense:
        return inner.groupBy("country").agg(
            *[F.sum(c).cast("double").alias(f"quarter_{i + 1}") for i, c in enumerate(cells)])
    # grouping again by the inner query's own keys changes nothing: a projection
    return inner.select("country", *[c.cast("double").alias(f"quarter_{i + 1}") for i, c in enumerate(cells)])


def monthly_growth(sales: DataFrame, start=None, *, pairs: DataFrame | None = None) -> DataFrame:
    """Month revenue and (revenue - prev) / prev with prev = greatest(lag, 1).

    greatest() skips NULL, so the first month divides by 1.  The window runs
    over one row per month (already aggregated), so its single partition is small.
    """
    m = _monthly(sales, start, pairs=pairs)
    prev = F.greatest(F.lag("_rev").over(Window.orderBy("_m")), F.lit(1))
    return (m.withColumn("_prev", prev).orderBy("_m")
            .select(F.col("_m").alias("months"), F.col("_rev").cast("double").alias("revenue"),
                    ((F.col("_rev") - F.col("_prev")).cast("double") / F.col("_prev").cast("double"))
                    .alias("growth_rate")))


def top_items_per_month(sales: DataFrame, start=None, n: int = 5) -> DataFrame:
    """Per month, the items whose rounded revenue has dense rank <= n
    (ties can give more than n rows).  A rank filter, which Spark plans with
    a partial group limit before the shuffle: each task ships at most the n
    best values of a month (plus ties), so no month's items meet in one task."""
    g = (since(sales, start, customers_only=True)
         .groupBy(F.col("Description").alias("description"), month_start("InvoiceDate").alias("delivr_month"),
                  month_year_label("InvoiceDate").alias("months"))
         .agg(F.round(F.sum("rev"), 3).alias("_rev")))
    top = top_k_distinct_per_group(g, ["delivr_month"], "_rev", n, out="rank")
    return top.select(F.col("description").alias("product_name"), F.col("months").alias("month"),
                      "rank", F.col("_rev").cast("double").alias("revenue"))
