"""Fixed schemas of the two inputs (no type inference at scale)."""

from pyspark.sql import types as T

# Retail invoice lines, as loaded from CSV: InvoiceDate arrives as text and is
# parsed by the cleaning step.
SALES_CSV = T.StructType([
    T.StructField("InvoiceNo", T.StringType()),
    T.StructField("StockCode", T.StringType()),
    T.StructField("Description", T.StringType()),
    T.StructField("Quantity", T.IntegerType()),
    T.StructField("InvoiceDate", T.StringType()),
    T.StructField("UnitPrice", T.DoubleType()),
    T.StructField("CustomerID", T.LongType()),
    T.StructField("Country", T.StringType()),
])

SALES_COLUMNS = [f.name for f in SALES_CSV.fields]
TEXT_COLUMNS = [f.name for f in SALES_CSV.fields if isinstance(f.dataType, T.StringType)]

# One row per page visit of the two-variant experiment.
VISITS_CSV = T.StructType([
    T.StructField("visit_date", T.DateType()),
    T.StructField("condition", T.StringType()),
    T.StructField("time_spent_homepage_sec", T.DoubleType()),
    T.StructField("clicked_article", T.IntegerType()),
    T.StructField("clicked_like", T.IntegerType()),
    T.StructField("clicked_share", T.IntegerType()),
])

CLICK_COLUMNS = ["clicked_article", "clicked_like", "clicked_share"]
