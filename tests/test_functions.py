import datetime as dt

from pyspark.sql import functions as F

from kpiloom.functions import (age_day, exact_round_div, pg_initcap, trunc_toward_zero, week_of_year_7day,
                               week_start, year_start_on_or_after)


def test_pg_initcap(spark):
    df = spark.createDataFrame([("HAND-WARMER it's",), ("   ",), ("",), (None,), ("3rd  éTE x1y",)], "s string")
    got = [r[0] for r in df.select(pg_initcap("s")).collect()]
    assert got == ["Hand-Warmer It'S", "   ", "", None, "3rd  Éte X1y"]


def test_dates(spark):
    d = lambda s: F.lit(dt.date.fromisoformat(s))
    r = spark.range(1).select(
        age_day(d("2011-12-09"), d("2011-01-09")).alias("a"),
        age_day(d("2011-12-09"), d("2011-11-30")).alias("b"),
        age_day(d("2011-12-09"), d("2011-01-31")).alias("c"),
        week_of_year_7day(d("2018-04-09")).alias("w1"),
        week_of_year_7day(d("2018-12-31")).alias("w2"),
        week_start(d("2011-01-01")).alias("ws"),
        week_start(d("2010-12-27")).alias("ws2"),
    ).first()
    assert (r.a, r.b, r.c) == (0, 9, 9)
    assert (r.w1, r.w2) == (15, 53)
    assert r.ws == r.ws2 == dt.date(2010, 12, 27)
    assert year_start_on_or_after("2011-01-01") == dt.date(2011, 1, 1)
    assert year_start_on_or_after("2011-03-05") == dt.date(2012, 1, 1)


def test_exact_round_div(spark):
    df = spark.createDataFrame([(1, 8), (-1, 8), (2, 3), (5, 0), (None, 2)], "a long, b long")
    assert [r[0] for r in df.select(exact_round_div("a", "b", 2)).collect()] == [0.13, -0.13, 0.67, None, None]
    dec = spark.createDataFrame([("1.005",), ("-1.005",), ("2.675",)], "x string").select(
        F.col("x").cast("decimal(18,4)").alias("x"))
    # decimal rounding half away from zero (a double 1.005 would round down)
    assert [r[0] for r in dec.select(exact_round_div("x", F.lit(1), 2)).collect()] == [1.01, -1.01, 2.68]


def test_trunc_toward_zero(spark):
    df = spark.createDataFrame([(v,) for v in ["50000", "-500", "-1500", "999.9", "350001", "-1000"]],
                               "x string").select(F.col("x").cast("decimal(18,4)").alias("x"))
    assert [r[0] for r in df.select(trunc_toward_zero("x", 1000)).collect()] == [50000, 0, -1000, 0, 350000, -1000]
