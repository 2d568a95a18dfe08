"""Adapters from the star-schema test tables to the two analysis inputs.

The retail view joins lineitem -> orders -> customer -> nation and
lineitem -> part.  Small dimensions are left to Spark's size-checked join
selection (autoBroadcastJoinThreshold, and AQE at run time); nothing is
broadcast by hint, so the plan stays valid when every table is large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sales_from_tables(spark: SparkSession, sf_dir: str, clean_text: str | None = None) -> DataFrame:
    """Raw retail lines (before cleaning), one per lineitem row.

    Column mapping (fixed by the test fixtures):
    InvoiceNo = order key; StockCode = part key; Description = padded part
    name with a hyphen, blank for every 17th part; Quantity negative for the
    first line of returned orders; InvoiceDate = order date; UnitPrice =
    part retail price; CustomerID NULL for every 13th order; Country =
    nation name, nation 24 written 'unspecified'.

    ``clean_text`` = ``"normalise"`` (C1) or ``"fill"`` (C1 + C2) cleans
    Description and Country on the part and nation rows *before* the join.
    Both are functions of those rows alone, so the result equals cleaning
    every line afterwards, while the regular-expression work runs once per
    part and once per nation instead of once per line.
    """
    from kpiloom.operators.cleaning import filled, normalised

    # what a line needs is computed before the joins, so that each shuffle carries a few numbers a line;
    # texts (names, and the keys as text) come last
    back = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey",
        F.when(back, -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("quantity"))
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("InvoiceDate"))
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select(
        "n_nationkey",
        F.when(F.col("n_nationkey") == 24, F.lit("unspecified")).otherwise(F.col("n_name")).alias("Country"))
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_retailprice",
        F.when(F.col("p_partkey") % 17 == 0, F.lit(" "))
         .otherwise(F.concat(F.lit(" "), F.upper("p_name"), F.lit("-x "))).alias("Description"))
    if clean_text:
        nation = nation.withColumn("Country", normalised("Country"))
        part = part.withColumn("Description", normalised("Description"))
        if clean_text == "fill":
            part = part.withColumn("Description", filled("Description"))

    # orders -> customer first: the smaller side, so lineitem is shuffled once for
    # the order join and once for the part join; the country is a number until the last join.
    oc = orders.join(cust, orders.o_custkey == cust.c_custkey).drop("c_custkey")
    j = li.join(oc, li.l_orderkey == oc.o_orderkey).drop("l_orderkey") \
        .join(part, li.l_partkey == part.p_partkey).join(nation, oc.c_nationkey == nation.n_nationkey)
    return j.select(
        F.col("o_orderkey").cast("string").alias("InvoiceNo"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        "Description", F.col("quantity").cast("int").alias("Quantity"), "InvoiceDate",
        F.col("p_retailprice").alias("UnitPrice"),
        F.when(F.col("o_orderkey") % 13 == 0, F.lit(None).cast("bigint"))
         .otherwise(F.col("o_custkey")).alias("CustomerID"),
        "Country",
    )


def visits_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Experiment visits from the event stream table.

    Variant by user parity (even -> tips); view, click and purchase events
    become the article, like and share flags; ``value`` is the time on page.
    ``ts`` and ``event_id`` are kept: sequential looks order visits by them.
    """
    ev = read_table(spark, sf_dir, "events")
    flag = lambda t: F.when(F.col("event_type") == t, 1).otherwise(0)
    return ev.select(
        F.col("ts").cast("date").alias("visit_date"),
        F.when(F.col("user_id") % 2 == 0, F.lit("tips")).otherwise(F.lit("tools")).alias("condition"),
        F.col("value").alias("time_spent_homepage_sec"),
        flag("view").alias("clicked_article"),
        flag("click").alias("clicked_like"),
        flag("purchase").alias("clicked_share"),
        "ts", "event_id",
    )
