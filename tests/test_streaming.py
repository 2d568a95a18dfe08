import datetime as dt

from kpiloom.operators.revenue import monthly_growth
from kpiloom.streaming import stream_sales_ingest, stream_visits_ingest

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"


def test_stream_sales_ingest_is_incremental(spark, tmp_path):
    src, table, ck = tmp_path / "in", tmp_path / "table", tmp_path / "ck"
    src.mkdir()
    (src / "a.csv").write_text(HEADER + "1,A, red  MUG ,2,1/5/2011 9:00,1.5,7,france\n"
                               "2,B,,1,1/6/2011 9:00,10,,france\n")
    q = stream_sales_ingest(spark, str(src), str(table), date_format="M/d/yyyy H:mm",
                            checkpoint_location=str(ck))
    q.awaitTermination()
    rows = spark.read.parquet(str(table)).collect()
    assert sorted((r.InvoiceNo, r.Description, r.Country) for r in rows) == [
        ("1", "Red  Mug", "France"), ("2", "Data_not_available", "France")]
    (src / "b.csv").write_text(HEADER + "3,C,cup,1,2/7/2011 10:00,4,8,spain\n")
    q = stream_sales_ingest(spark, str(src), str(table), date_format="M/d/yyyy H:mm",
                            checkpoint_location=str(ck))
    q.awaitTermination()
    t = spark.read.parquet(str(table))
    assert t.count() == 3  # the first file is not read twice
    g = {r.months: r.revenue for r in monthly_growth(t, "2011-01-01").collect()}
    assert g == {dt.date(2011, 1, 1): 13.0, dt.date(2011, 2, 1): 4.0}


def test_stream_visits_ingest(spark, tmp_path):
    src = tmp_path / "v"
    src.mkdir()
    (src / "a.csv").write_text("visit_date,condition,time_spent_homepage_sec,clicked_article,clicked_like,"
                               "clicked_share\n2018-04-09,tips,10.5,1,0,0\n")
    q = stream_visits_ingest(spark, str(src), str(tmp_path / "t"), checkpoint_location=str(tmp_path / "ck"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "t")).first().visit_date == dt.date(2018, 4, 9)


def test_two_applications_lose_nothing(tmp_path):
    """A later application, by default, goes on where the first one stopped."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    src = tmp_path / "in"
    src.mkdir()
    script = (f"import sys; sys.path.insert(0, {repo!r})\n"
              "from kpiloom.session import get_spark\n"
              "from kpiloom.streaming import stream_sales_ingest\n"
              f"s = get_spark('local[2]', extra={{'spark.checkpoint.dir': {str(tmp_path / 'ck')!r}}})\n"
              f"stream_sales_ingest(s, {str(src)!r}, {str(tmp_path / 't')!r}, date_format='M/d/yyyy H:mm').awaitTermination()\n"
              f"print('ROWS', s.read.parquet({str(tmp_path / 't')!r}).count())\n")
    for i in (1, 2):
        (src / f"f{i}.csv").write_text(HEADER + f"{i},A,mug,2,1/5/2011 9:00,1.5,7,france\n")
        out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
        assert f"ROWS {i}" in out.stdout, out.stderr[-2000:]
