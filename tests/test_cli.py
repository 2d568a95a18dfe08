from kpiloom.__main__ import main

from .conftest import SF_SMALL


def test_cli_list_and_run(spark, tmp_path, capsys):
    assert main(["list"]) == 0
    assert "V11_monthly_growth" in capsys.readouterr().out
    out = tmp_path / "out"
    assert main(["run", "--sf-dir", SF_SMALL, "--out", str(out), "--format", "csv",
                 "V11_monthly_growth", "X9_welch_test_p"]) == 0
    assert spark.read.option("header", True).csv(str(out / "V11_monthly_growth")).count() > 0
    assert spark.read.option("header", True).csv(str(out / "X9_welch_test_p")).count() == 1


def test_cli_report(spark, tmp_path):
    out = tmp_path / "rep"
    assert main(["report", "--sf-dir", SF_SMALL, "--out", str(out)]) == 0
    assert spark.read.parquet(str(out / "R5_rfm_segments")).count() > 0
    assert spark.read.parquet(str(out / "B3_revenue_intervals")).count() == 10


def test_cli_table_path_reused(spark, tmp_path):
    table = tmp_path / "sales"
    for _ in range(2):  # second run reads the stable table
        assert main(["run", "--sf-dir", SF_SMALL, "--out", str(tmp_path / "o"), "--table-path", str(table),
                     "V8_monthly_revenue"]) == 0
    assert (table / "_SUCCESS").exists()


def test_cli_from_csv(spark, tmp_path):
    sales, visits = tmp_path / "sales.csv", tmp_path / "visits.csv"
    sales.write_text("InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
                     "1,A,red mug,2,1/5/2011 9:00,1.5,7.0,france\n2,B,cup,1,2/6/2011 9:00,10,8,france\n")
    visits.write_text("visit_date,condition,time_spent_homepage_sec,clicked_article,clicked_like,clicked_share\n"
                      "2018-04-09,tips,10.5,1,0,0\n2018-04-10,tools,11.5,1,1,0\n")
    out = tmp_path / "out"
    assert main(["run", "--sales-csv", str(sales), "--visits-csv", str(visits), "--date-format", "M/d/yyyy H:mm",
                 "--out", str(out), "V8_monthly_revenue", "X7_mean_time", "F4_row_count"]) == 0
    assert {r.months: r.revenue for r in spark.read.parquet(str(out / "V8_monthly_revenue")).collect()} == {
        "January": 3.0, "February": 10.0}
    assert spark.read.parquet(str(out / "X7_mean_time")).count() == 2
    rep = tmp_path / "rep"
    assert main(["report", "--sales-csv", str(sales), "--date-format", "M/d/yyyy H:mm", "--start", "2011-02-01",
                 "--out", str(rep)]) == 0
    assert spark.read.parquet(str(rep / "V8_monthly_revenue")).count() == 1


def test_table_of_other_input_is_refused_or_rebuilt(spark, tmp_path):
    import pytest
    from kpiloom.sources.store import cleaned_sales
    table = str(tmp_path / "t")
    n = cleaned_sales(spark, SF_SMALL, table).count()
    assert cleaned_sales(spark, SF_SMALL, table).count() == n
    with pytest.raises(ValueError, match="other input"):
        cleaned_sales(spark, "/root/testdata/sf0.01", table)
    assert cleaned_sales(spark, "/root/testdata/sf0.01", table, rebuild=True).count() == 10 * n
    (tmp_path / "t" / "_SUCCESS").unlink()          # an interrupted write is built again
    assert cleaned_sales(spark, SF_SMALL, table).count() == n
    (tmp_path / "mine").mkdir()
    (tmp_path / "mine" / "notes.txt").write_text("x")
    with pytest.raises(ValueError, match="no cleaned table"):
        cleaned_sales(spark, SF_SMALL, str(tmp_path / "mine"))
