"""Figures taken while a table is written: equal to a scan, and left aside once the files change."""

import pytest
from pyspark.sql import functions as F

from kpiloom.operators import profile
from kpiloom.session import hadoop_path
from kpiloom.sources import profiled

from .conftest import line, make_sales


@pytest.fixture
def table(spark, tmp_path):
    rows = [line(i, None if i % 5 == 0 else f"item {i}", i, f"20{10 + i % 3}-03-{1 + i % 28:02d}", 1.5, None if i % 3 else i)
            for i in range(400)]
    sales = make_sales(spark, rows).withColumn("year", F.year("InvoiceDate")).withColumn("odd.name", F.lit(None).cast("int"))
    path = str(tmp_path / "sales")
    profiled.write_profiled(sales.repartition(7), path, cluster_by="InvoiceDate", partition_by="year")
    return path, sales


def _three(spark, path):
    return [profiled.non_null_counts(spark, path).collect(), profiled.row_count(spark, path).collect(),
            profiled.date_range(spark, path, "InvoiceDate").collect()]


def _scanned(df):
    return [profile.non_null_counts(df).collect(), profile.row_count(df).collect(),
            profile.date_range(df, "InvoiceDate").collect()]


def test_figures_equal_a_scan_and_read_no_file(spark, table):
    path, sales = table
    assert profiled.figures_of(spark, path)["values"]["odd.name"] == 0
    assert _three(spark, path) == _scanned(sales)
    for df in (profiled.non_null_counts(spark, path), profiled.row_count(spark, path),
               profiled.date_range(spark, path, "InvoiceDate")):
        assert "FileScan" not in df._jdf.queryExecution().executedPlan().toString()
    wanted = profiled.non_null_counts(spark, path, ["CustomerID", "odd.name"]).first()
    assert (wanted.customer_not_null_count, wanted[1]) == (sales.where("CustomerID IS NOT NULL").count(), 0)
    # a column without a stored range is scanned
    assert profiled.date_range(spark, path, "Quantity").first().max_date == 399


def test_changed_files_are_scanned(spark, table):
    path, sales = table
    more = sales.limit(10)
    more.write.mode("append").partitionBy("year").parquet(path)
    assert profiled.figures_of(spark, path) is None
    assert _three(spark, path)[1][0].n == 410
    assert _three(spark, path) == _scanned(spark.read.parquet(path))


def test_table_without_figures_and_empty_table(spark, table, tmp_path):
    path, sales = table
    fs, figures = hadoop_path(spark, f"{path}/{profiled.FIGURES}")
    fs.delete(figures, False)
    assert profiled.figures_of(spark, path) is None and _three(spark, path)[1][0].n == 400
    empty = str(tmp_path / "empty")
    profiled.write_profiled(sales.limit(0), empty)
    assert profiled.figures_of(spark, empty)["rows"] == 0
    assert _three(spark, empty) == _scanned(spark.read.parquet(empty))
