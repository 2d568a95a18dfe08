import datetime as dt
import itertools

from pyspark.sql import functions as F

from kpiloom.operators import buckets, rfm

from .conftest import line, make_sales


def _per_customer(spark, revenues):
    return make_sales(spark, [line(i, "A", 1, "2011-02-01", float(v), i) for i, v in enumerate(revenues)])


def test_revenue_intervals_edges(spark):
    s = _per_customer(spark, [50000, -500, -1500, 999.9, 350001, 350000, 0])
    got = {(r.lower_class, r.upper_class): r.customer_number
           for r in buckets.revenue_intervals(s, "2011-01-01").collect()}
    assert len(got) == 7
    assert got[(0, 50000)] == 3       # 999.9, 0 and the shared edge 50000
    assert got[(50000, 100000)] == 1  # 50000 again
    assert got[(300000, 350000)] == 1  # 350000; 350001 is lost
    assert got[(100000, 150000)] == 0
    plan = buckets.revenue_intervals(s, "2011-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan


def test_revenue_classes_and_groups(spark):
    s = _per_customer(spark, [50000, -500, -1500, 999.9, 672.05, 2110.05, 672, 3000])
    cls = {r.revenue_category: r.customers for r in buckets.revenue_classes(s, "2011-01-01").collect()}
    assert cls == {50000: 1, 0: 4, -1000: 1, 2000: 1, 3000: 1}
    grp = {r.revenue_group: r.customers for r in buckets.revenue_groups(s, "2011-01-01").collect()}
    # 672.05 and 2110.05 fall in the gaps between the cut-offs: the NULL group
    assert grp == {"Low-revenue users": 3, "Mid-revenue users": 1, "High-revenue users": 2, None: 2}


def test_distributions(spark):
    s = _per_customer(spark, [1.0, 2.0, 4.0, 10.005])
    r = buckets.revenue_distribution(s, "2011-01-01").first()
    assert (r.min_revenue, r.median_revenue, r.avg_revenue, r.max_revenue) == (1.0, 3.0, 4.25, 10.01)
    o = make_sales(spark, [line(inv, "A", 1, "2011-02-01", 1.0, c)
                           for c, n in [(1, 1), (2, 2), (3, 4), (4, 12)] for inv in range(c * 100, c * 100 + n)])
    d = buckets.orders_distribution(o, "2011-01-01").first()
    assert (d.min_count, d.median_count, d.seventyfive_percentile_count, d.avg_count, d.max_count) == (
        1.0, 3.0, 6.0, 4.75, 12.0)
    g = {r.order_number_group: r.customers for r in buckets.order_groups(o, "2011-01-01").collect()}
    assert g == {"Low-orders users": 2, "Mid-orders users": 1, "High-orders users": 1}
    h = {r.number_of_orders: r.customer_number for r in buckets.orders_histogram(o, "2011-01-01").collect()}
    assert h == {1: 1, 2: 1, 4: 1, 12: 1}


def test_segment_reachability(spark):
    triples = list(itertools.product(range(1, 6), repeat=3))
    df = spark.createDataFrame(triples, "rfm_recency long, rfm_freq long, rfm_monetary long").withColumn(
        "customer_id", F.monotonically_increasing_id())
    counts = dict(rfm.rfm_segments(df).groupBy("customer_segments").count().collect())
    assert counts == {"Champions": 8, "Loyal Customers": 56, "Potential Loyalist": 15, "About To Sleep": 3,
                      "At Risk": 16, "Hibernating": 3, "other": 24}


def test_recency_and_scores(spark):
    s = make_sales(spark, [line(1, "A", 1, "2011-01-09", 1.0, 1), line(2, "A", 1, "2011-11-30", 2.0, 2),
                           line(3, "A", 1, "2011-01-31", 3.0, 3), line(4, "A", 1, "2011-12-09", 1.0, None)])
    base = rfm.rfm_base(s, "2011-01-01")
    rec = dict(rfm.rfm_recency(base, sales=s).collect())
    assert rec == {1: 0, 2: 9, 3: 9}
    days = dict(rfm.rfm_recency(base, ref=dt.date(2011, 12, 9), recency="total_days").collect())
    assert days[1] == 334
    comb = rfm.rfm_combined(base, sales=s)
    # fewer customers than tiles: ntile gives 1, 2, 3
    sc = {r.customer_id: (r.rfm_recency, r.rfm_freq, r.rfm_monetary) for r in rfm.rfm_scores(comb).collect()}
    assert sc == {1: (3, 1, 1), 2: (1, 2, 2), 3: (2, 3, 3)}
    joined = rfm.rfm_combined(base, rfm.rfm_recency(base, sales=s))
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, comb.collect()))
    t3 = {r.customer_id: r.recency_segment for r in rfm.rfm_three_tier(base).collect()}
    assert t3 == {1: "Long_standing_customer", 3: "Relatively_recent_customer", 2: "Recent_customer"}


def test_revenue_distribution_approx(spark):
    s = _per_customer(spark, [1.0, 2.0, 4.0, 10.005, 7.0])
    r = buckets.revenue_distribution(s, "2011-01-01", approx=True).first()
    assert r.median_revenue == 4.0 and r.min_revenue == 1.0 and r.max_revenue == 10.01


def test_orders_distribution_approx(spark):
    o = make_sales(spark, [line(inv, "A", 1, "2011-02-01", 1.0, c)
                           for c, n in [(1, 1), (2, 2), (3, 4), (4, 12), (5, 4)] for inv in range(c * 100, c * 100 + n)])
    d = buckets.orders_distribution(o, "2011-01-01", approx=True).first()
    assert (d.min_count, d.median_count, d.seventyfive_percentile_count, d.max_count) == (1.0, 4.0, 4.0, 12.0)
