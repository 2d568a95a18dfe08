"""Profiling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.operators.common import since

# PostgreSQL names of the column types (information_schema).
PG_TYPE_NAMES = {
    "string": "text", "int": "integer", "bigint": "bigint", "smallint": "smallint",
    "double": "double precision", "float": "real", "date": "date", "boolean": "boolean",
    "timestamp": "timestamp with time zone", "timestamp_ntz": "timestamp without time zone",
}
# F2 output names for the eight retail columns, in the reference's order.
NON_NULL_NAMES = {
    "InvoiceNo": "invoice_not_null_count",
    "Description": "description_not_null_count",
    "CustomerID": "customer_not_null_count",
    "StockCode": "stockcode_not_null_count",
    "Quantity": "quantity_not_null_count",
    "UnitPrice": "unitprice_not_null_count",
    "InvoiceDate": "date_not_null_count",
    "Country": "country_not_null_count",
}


def column_types(df: DataFrame) -> DataFrame:
    """one row per column: column_name, data_type (PostgreSQL spelling;
    decimals as ``numeric``).  Built from the schema; no data is read."""
    rows = []
    for f in df.schema.fields:
        s = f.dataType.simpleString()
        rows.append((f.name, "numeric" if isinstance(f.dataType, T.DecimalType) else PG_TYPE_NAMES.get(s, s)))
    return df.sparkSession.createDataFrame(rows, "column_name string, data_type string")


def non_null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """per column, how many values are not NULL (NULL on empty input, as SUM is)."""
    cols = list(cols) if cols else [c for c in NON_NULL_NAMES if c in df.columns]
    return df.agg(*[F.sum(F.when(F.col(c).isNotNull(), 1).otherwise(0)).cast("bigint")
                    .alias(NON_NULL_NAMES.get(c, f"{c.lower()}_not_null_count")) for c in cols])


def distinct_counts(sales: DataFrame, start) -> DataFrame:
    """distinct countries, customers, descriptions since ``start``; NULLs ignored.

    Each is a distinct aggregate over a scan of its own column, so no row is
    multiplied by the number of counts, and every value leaves a task once."""
    rows = since(sales, start)
    n = lambda c: rows.select(c).distinct().agg(F.count(c).alias("n"))
    return n("Country").select(F.col("n").alias("countries"), n("CustomerID").scalar().alias("customers"),
                               n("Description").scalar().alias("description_items"))


def row_count(df: DataFrame) -> DataFrame:
    """F4"""
    return df.agg(F.count(F.lit(1)).alias("n"))


def date_range(df: DataFrame, col: str = "visit_date") -> DataFrame:
    """R's range(): min and max."""
    return df.agg(F.min(col).alias("min_date"), F.max(col).alias("max_date"))
