"""Temp views for users who query with SQL, as the reference's users do.

``register_views`` exposes the cleaned retail table as ``ecommerce_data``
(columns as in the reference, plus ``rev``) and the experiment visits as
``ab_visits``.  PostgreSQL's double-quoted identifiers become back-quoted
ones in Spark SQL (``"CustomerID"`` -> `` `CustomerID` ``); a double-quoted
token is a string literal in Spark.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from kpiloom.sources.store import cleaned_sales, pinned_visits
from kpiloom.sources.tables import visits_from_events


def register_views(spark: SparkSession, sf_dir: str, sales_view: str = "ecommerce_data",
                   visits_view: str = "ab_visits") -> None:
    cleaned_sales(spark, sf_dir).createOrReplaceTempView(sales_view)
    visits = pinned_visits(spark, sf_dir)       # CSV input, see store.pin_csv
    (visits_from_events(spark, sf_dir) if visits is None else visits).createOrReplaceTempView(visits_view)
