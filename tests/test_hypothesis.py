"""Property tests: the column helpers against plain-Python definitions."""

import calendar
import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from kpiloom.functions import age_day, exact_round_div, pg_initcap, trunc_toward_zero, week_of_year_7day

SETTINGS = settings(max_examples=15, deadline=None)
TEXT = st.text(alphabet=st.sampled_from(list("abcXYZ019 -'_./\téÉßü")), max_size=20)


def py_initcap(s):
    out, prev = [], False
    for ch in s:
        if ch.isalnum():
            out.append(ch.lower() if prev else ch.upper())
            prev = True
        else:
            out.append(ch)
            prev = False
    return "".join(out)


def py_age_day(ref, d):
    diff = ref.day - d.day
    return diff if diff >= 0 else diff + calendar.monthrange(d.year, d.month)[1]


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=30))
def test_initcap_matches_definition(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(pg_initcap("s")).collect()]
    assert got == [py_initcap(t) for t in texts]


@SETTINGS
@given(st.lists(st.tuples(st.dates(dt.date(1990, 1, 1), dt.date(2030, 12, 31)),
                          st.integers(0, 4000)), min_size=1, max_size=40))
def test_age_day_and_week(spark, pairs):
    rows = [(d + dt.timedelta(days=k), d) for d, k in pairs]
    df = spark.createDataFrame(rows, "ref date, d date")
    got = df.select(age_day("ref", "d"), week_of_year_7day("d")).collect()
    assert [r[0] for r in got] == [py_age_day(a, b) for a, b in rows]
    assert [r[1] for r in got] == [(b.timetuple().tm_yday - 1) // 7 + 1 for _, b in rows]


@SETTINGS
@given(st.lists(st.tuples(st.decimals(min_value=-10**9, max_value=10**9, places=4, allow_nan=False),
                          st.integers(1, 10**6)), min_size=1, max_size=40))
def test_exact_round_div_and_trunc(spark, pairs):
    df = spark.createDataFrame([(str(n), d) for n, d in pairs], "n string, d long").select(
        F.col("n").cast("decimal(18,4)").alias("n"), "d")
    got = df.select(exact_round_div("n", "d", 2), trunc_toward_zero("n", 1000)).collect()
    want = [float((n / Decimal(d)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) for n, d in pairs]
    assert [r[0] for r in got] == want
    assert [r[1] for r in got] == [int(n / 1000) * 1000 for n, _ in pairs]


ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.integers(0, 2)), min_size=0, max_size=60)


@settings(max_examples=8, deadline=None)
@given(ROWS, st.integers(1, 7))
def test_selection_equals_windows(spark, rows, tiles):
    from kpiloom.plans import dense_rank, exact_percentiles, ntiles
    df = spark.createDataFrame([(i, v, g) for i, (v, g) in enumerate(rows)], "id long, v long, g long")
    window = lambda f, *order: f.over(Window.orderBy(*order))
    r = ntiles(df, tiles, {"t": ("v", False)}, "id") if tiles > 1 else df.withColumn("t", F.lit(1))
    w = df.withColumn("w", window(F.ntile(tiles), F.col("v").desc_nulls_first(), "id"))
    assert r.join(w.select("id", "w"), "id").where("t <> w").isEmpty()
    d = df.withColumn("w", window(F.dense_rank(), F.col("v").desc_nulls_first())).select("id", "w")
    assert dense_rank(df, "v", "r").join(d, "id").where("r <> w").isEmpty()
    probs = {"q0": 0.0, "q1": 0.3, "q2": 0.5, "q3": 1.0}
    got = {x.g: tuple(x[k] for k in probs) for x in exact_percentiles(df, "v", probs, ["g"], exact_decimal=False).collect()}
    want = {x.g: tuple(x[k] for k in probs) for x in
            df.groupBy("g").agg(*[F.percentile("v", p).alias(k) for k, p in probs.items()]).collect()}
    assert got.keys() == want.keys()
    for g, values in want.items():
        assert got[g] == (values if None in values else pytest.approx(values, rel=1e-12))
