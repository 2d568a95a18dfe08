import datetime as dt

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import functions as F

from kpiloom.functions.stats import t_quantile, t_two_sided_p
from kpiloom.operators import experiment as X
from kpiloom.sources.tables import visits_from_events

from .conftest import SF_CHECK

V_DDL = ("visit_date date, condition string, time_spent_homepage_sec double, clicked_article int, "
         "clicked_like int, clicked_share int")


def test_known_values_sf001(spark):
    v = visits_from_events(spark, SF_CHECK)
    lt = {r.term: r for r in X.logit_test(v, "clicked_like").collect()}
    s = lt["conditiontools"]
    assert s.estimate == pytest.approx(0.03135281, abs=1e-8)
    assert s.std_error == pytest.approx(0.04995568, abs=1e-8)
    assert s.p_value == pytest.approx(0.5303, abs=1e-4)
    w = X.welch_test(v).first()
    assert w.statistic == pytest.approx(1.920887, abs=1e-6)
    assert w.df == pytest.approx(9956.8997, abs=1e-4)
    assert w.p_value == pytest.approx(t_two_sided_p(w.statistic, w.df))
    assert w.conf_low < w.mean_tips - w.mean_tools < w.conf_high


def test_logit_matches_spark_ml(spark):
    v = visits_from_events(spark, SF_CHECK)
    data = VectorAssembler(inputCols=["tools"], outputCol="features").transform(
        v.select((F.col("condition") == "tools").cast("double").alias("tools"),
                 F.col("clicked_like").cast("double").alias("label")))
    m = GeneralizedLinearRegression(family="binomial", link="logit").fit(data)
    lt = {r.term: r for r in X.logit_test(v, "clicked_like", with_p=False).collect()}
    assert lt["conditiontools"].estimate == pytest.approx(m.coefficients[0], rel=1e-6)
    assert lt["(Intercept)"].estimate == pytest.approx(m.intercept, rel=1e-6)
    assert lt["conditiontools"].std_error == pytest.approx(m.summary.coefficientStandardErrors[0], rel=1e-5)


def test_zero_cell_and_na(spark):
    rows = [(dt.date(2018, 4, 9), "tips", 10.0, 0, 0, 0), (dt.date(2018, 4, 9), "tools", None, 1, 1, 0),
            (dt.date(2018, 12, 31), "tools", 30.0, 0, None, 1)]
    v = spark.createDataFrame(rows, V_DDL)
    assert all(r.estimate is None for r in X.logit_test(v, "clicked_like").collect())
    rates = {(r.click_types, r.condition): r.conversion_rate for r in X.conversion_rates(v).collect()}
    assert rates[("clicked_like", "tools")] is None  # a NULL without na_rm
    assert rates[("clicked_share", "tools")] == 0.5
    weeks = sorted({r.week for r in X.weekly_conversion(v).collect()})
    assert weeks == [15, 53]
    t = {r.condition: r.time_spent for r in X.mean_time(v).collect()}
    assert t == {"tips": 10.0, "tools": 30.0}  # na_rm=True
    ct = X.conversion_crosstab(v).orderBy("click_types").collect()
    assert ct[1].tips == 0.0 and ct[1].tools == 0.5
    wt = {(r.week, r.condition): r for r in X.weekly_time(v).collect()}
    assert wt[(15, "tools")].time_spent is None and wt[(15, "tools")].time_median is None
    assert wt[(15, "tips")].time_median == 10.0


def test_sample_size_formula(spark):
    assert X.sample_size_formula(0.2, 0.3, 0.5) == 587
    assert X.sample_size_formula(0.032, 0.082, 0.5) == 673
    rows = [(dt.date(2018, 1, 1), "tips" if i % 2 else "tools", 1.0, 0, 0, 1 if i < 32 else 0) for i in range(1000)]
    v = spark.createDataFrame(rows, V_DDL)
    r = X.sample_size(v, "clicked_share", 0.05).first()
    assert (round(r.p1, 3), round(r.p2, 3), r.share, r.n) == (0.032, 0.082, 0.5, 673)


def test_t_distribution():
    assert t_two_sided_p(2.0, 10) == pytest.approx(0.07338803477, rel=1e-9)
    assert t_quantile(0.975, 10) == pytest.approx(2.228138852, rel=1e-9)
    assert t_quantile(0.975, 1e9) == pytest.approx(1.959963985, rel=1e-7)


def test_sequential_looks(spark):
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(40):
        rows.append((i, base + dt.timedelta(minutes=i), "tips", 1 if i % 4 == 0 else 0))
        rows.append((100 + i, base + dt.timedelta(minutes=i), "tools", 1 if i < 20 else 0))
    v = spark.createDataFrame(rows, "event_id long, ts timestamp, condition string, clicked_like int")
    got = X.sequential_looks(v, "clicked_like", n_per_group=30, k=3, boundary=1.992).collect()
    assert [(r.look, r.n_tips, r.n_tools) for r in got] == [(1, 10, 10), (2, 20, 20), (3, 30, 30)]
    assert [r.y_tools for r in got] == [10, 20, 20]
    assert [r.stop for r in got].count(True) == 1 and got[0].stop == got[0].crossed


def test_sample_size_by_segment(spark):
    rows = [(dt.date(2018, 1, 1 + ((i // 2) % 2) * 7), "tips" if i % 2 else "tools", 1.0, 0, 0,
             1 if i % 10 == 0 else 0) for i in range(400)]
    v = spark.createDataFrame(rows, V_DDL).withColumn("visit_week", F.weekofyear("visit_date"))
    got = X.sample_size(v, "clicked_share", 0.05, segments=["visit_week"]).collect()
    assert len(got) == 2 and all(r.n > 0 and r.share == 0.5 for r in got)
    # one variant only: no design, NULL size instead of a division error
    one = X.sample_size(v.where(F.col("condition") == "tips"), "clicked_share", 0.05).first()
    assert one.share == 0.0 and one.n is None


def test_welch_degenerate(spark):
    rows = [(dt.date(2018, 1, 1), c, 5.0, 0, 0, 0) for c in ("tips", "tips", "tools", "tools")]
    w = X.welch_test(spark.createDataFrame(rows, V_DDL)).first()
    assert w.statistic is None and w.p_value is None and w.mean_tips == 5.0
    one = X.welch_test(spark.createDataFrame(rows[:3], V_DDL)).first()
    assert one.statistic is None


def test_weekly_time_approx_close_to_exact(spark):
    v = visits_from_events(spark, SF_CHECK)
    exact = {(r.week, r.condition): r for r in X.weekly_time(v).collect()}
    approx = {(r.week, r.condition): r for r in X.weekly_time(v, approx=True).collect()}
    assert exact.keys() == approx.keys()
    for k, e in exact.items():
        a = approx[k]
        assert (a.time_min, a.time_max) == (e.time_min, e.time_max)
        assert a.time_spent == pytest.approx(e.time_spent, rel=1e-12)
        assert abs(a.time_median - e.time_median) <= 1.0


def test_boundary_belongs_to_three_looks(spark):
    v = spark.createDataFrame([(dt.datetime(2024, 1, 1), i, "tips" if i % 2 else "tools", i % 3 == 0)
                               for i in range(40)], "ts timestamp, event_id long, condition string, clicked_like boolean")
    v = v.withColumn("clicked_like", v.clicked_like.cast("int"))
    assert len(X.sequential_looks(v, n_per_group=10).collect()) == 3
    with pytest.raises(ValueError, match="boundary"):
        X.sequential_looks(v, n_per_group=10, k=5)
    assert len(X.sequential_looks(v, n_per_group=10, k=5, boundary=2.12).collect()) == 5
    # a design longer than the data uses every visit
    assert [r.n_tips for r in X.sequential_looks(v, n_per_group=60).collect()] == [20, 20, 20]


def test_t_tail_for_many_degrees_of_freedom():
    from kpiloom.functions import stats
    assert t_two_sided_p(2.0, 1e12) == pytest.approx(stats.normal_two_sided_p(2.0), rel=1e-10)
    assert t_two_sided_p(2.0, 2e8) == pytest.approx(t_two_sided_p(2.0, 9e7), rel=1e-6)
    with pytest.raises(ArithmeticError):
        stats.MAX_TERMS, before = 3, stats.MAX_TERMS
        try:
            stats._beta_fraction(5.0, 0.5, 0.8)
        finally:
            stats.MAX_TERMS = before


def _rows_scanned(df):
    """Rows that the scans of the main plan gave (subqueries aside), after it ran."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if name == "FileSourceScanExec":
                found.append(node.metrics().apply("numOutputRows").value())
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return sum(found)


def test_sequential_looks_skip_what_came_later(spark, tmp_path):
    """The counting pass reads the row groups up to the last look; all rows count where a variant has too few."""
    path = str(tmp_path / "visits")
    n = 40_000
    made = spark.range(n, numPartitions=1).select(
        F.when(F.col("id") % 2 == 0, "tips").otherwise("tools").alias("condition"), (F.col("id") % 3 == 0).cast("int").alias("clicked_like"),
        F.timestamp_seconds(F.floor(F.col("id") / 5)).alias("ts"), F.col("id").alias("event_id"))
    made.write.option("maxRecordsPerFile", 1000).parquet(path)
    visits = spark.read.parquet(path)
    read = {}
    for each in (300, 6000, 15_000, 30_000):
        looks = X.sequential_looks(visits, n_per_group=each, k=3)
        rows = looks.collect()
        read[each] = _rows_scanned(looks)
        for r, wanted in zip(rows, (each // 3, 2 * each // 3, each)):
            m = min(wanted, n // 2)
            assert (r.n_tips, r.n_tools) == (m, m)
            assert (r.y_tips, r.y_tools) == (sum(i % 3 == 0 for i in range(0, 2 * m, 2)), sum(i % 3 == 0 for i in range(1, 2 * m, 2)))
    assert read[300] <= 1000 and read[6000] <= 13_000 and read[15_000] <= 31_000 and read[30_000] == n


def test_sequential_looks_with_visits_without_time(spark, tmp_path):
    rows = [("tips" if i % 2 else "tools", i % 2, None if i >= 30 else dt.datetime(2020, 1, 1, 0, i), i) for i in range(40)]
    path = str(tmp_path / "visits")
    spark.createDataFrame(rows, "condition string, clicked_like int, ts timestamp, event_id long").write.parquet(path)
    visits = spark.read.parquet(path)
    assert [r.n_tips for r in X.sequential_looks(visits, n_per_group=18).collect()] == [6, 12, 18]     # untimed visits come last
    assert [r.n_tips for r in X.sequential_looks(visits, n_per_group=60).collect()] == [20, 20, 20]
