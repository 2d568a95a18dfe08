import datetime as dt

import pytest

from kpiloom.operators import customers, economics, revenue

from .conftest import line, make_sales


@pytest.fixture()
def months(spark):
    # Jan: 1000.5, Feb: gap (none), Mar: 0.5 (below 1), Apr: 20
    return make_sales(spark, [
        line(1, "A", 1, "2011-01-05", 1000.5, 1),
        line(2, "A", 1, "2011-03-05", 0.5, 1),
        line(3, "B", 2, "2011-04-05", 10.0, 2),
        line(4, "B", 2, "2010-12-05", 10.0, 2),  # before start
    ])


def test_monthly_growth(months):
    rows = revenue.monthly_growth(months, "2011-01-01").collect()
    assert [r.months for r in rows] == [dt.date(2011, 1, 1), dt.date(2011, 3, 1), dt.date(2011, 4, 1)]
    # first month divides by greatest(NULL, 1) = 1; previous 0.5 is clamped to 1
    assert rows[0].growth_rate == pytest.approx(999.5)
    assert rows[1].growth_rate == pytest.approx((0.5 - 1000.5) / 1000.5)
    assert rows[2].growth_rate == pytest.approx(19.0)


def test_weekly_and_quarters(spark):
    s = make_sales(spark, [line(1, "A", 1, "2011-01-01", 2.0, 1), line(2, "A", 1, "2011-04-01", 3.0, None),
                           line(3, "A", -1, "2011-07-01", 3.0, 1)])
    w = revenue.weekly_revenue(s, "2011-01-01").collect()
    assert w[0].delivr_week == dt.date(2010, 12, 27)
    q = {r.deliver_quarter: r.revenue for r in revenue.quarterly_revenue(s, "2011-01-01").collect()}
    assert q == {"Q1 2011": 2.0, "Q2 2011": 3.0}  # Q3 is negative: dropped by HAVING
    sparse = revenue.quarterly_revenue_by_country(s, "2011-01-01").collect()
    assert len(sparse) == 2 and sparse[0].quarter_3 is None
    dense = revenue.quarterly_revenue_by_country(s, "2011-01-01", dense=True).collect()
    assert len(dense) == 1 and (dense[0].quarter_1, dense[0].quarter_2) == (2.0, 3.0)


def test_top_items_per_month_ties(spark):
    rows = [line(i, f"Item{i}", 1, "2011-01-10", 10.0, 1) for i in range(6)]
    rows += [line(9, "Big", 1, "2011-01-11", 50.0, 1), line(10, "Small", 1, "2011-01-12", 1.0, 1)]
    rows += [line(11, "Other", 1, "2011-02-12", 1.0, 1)]
    got = revenue.top_items_per_month(make_sales(spark, rows), "2011-01-01", 2).collect()
    jan = [r for r in got if r.month == "January 2011"]
    assert len(jan) == 7  # Big (rank 1) + six tied items (rank 2)
    assert sorted({r.rank for r in jan}) == [1, 2]
    assert [r.product_name for r in got if r.month == "February 2011"] == ["Other"]


def test_item_country_ranks(spark):
    s = make_sales(spark, [line(1, "Data_not_available", 1, "2011-01-10", 5.0, 1),
                           line(2, "B", 1, "2011-01-10", 5.0, 1, country="Unspecified"),
                           line(3, "C", 1, "2011-01-10", 7.0, 2), line(4, "C", 1, "2011-01-10", 7.0, None)])
    v1 = revenue.item_country_revenue(s, "2011-01-01")
    got = {(r.item_description, r.country): (r.item_rank, r.revenue) for r in v1.collect()}
    assert got == {("Data_Not_Available", "Nation_1"): (2, 5.0), ("B", "Unspecified"): (2, 5.0),
                   ("C", "Nation_1"): (1, 7.0)}
    c = {r.country: (r.country_rank, r.revenue) for r in revenue.country_revenue(v1).collect()}
    assert c == {"Nation_1": (1, 12.0)}
    assert revenue.top_countries(v1, 1).first().country == "Nation_1"


def test_customer_activity(spark):
    s = make_sales(spark, [
        line(1, "A", 1, "2011-01-03", 1.0, 1), line(2, "A", 1, "2011-01-03", 1.0, 2),
        line(3, "A", 1, "2011-01-03", 1.0, 3), line(4, "A", 1, "2011-01-03", 1.0, None),
        line(5, "A", 1, "2011-02-03", 1.0, 2), line(6, "A", 1, "2011-03-03", 1.0, 3),
        line(7, "A", 1, "2011-02-03", 1.0, None)])
    ret = {r.delivr_month: r.retention_rate for r in customers.retention(s, "2011-01-01").collect()}
    # Jan: 1 of 3 back in Feb; Feb: 0 of 1 in Mar; Mar: last month -> 0
    assert ret == {dt.date(2011, 1, 1): 0.33, dt.date(2011, 2, 1): 0.0, dt.date(2011, 3, 1): 0.0}
    act = customers.active_customers(s, "2011-01-01").collect()
    assert [(r.current_customer_count, r.previous_customer_count) for r in act] == [(3, 0), (1, 3), (1, 1)]
    g = customers.active_customer_growth(s, "2011-01-01").collect()
    assert g[0].growth_rate == 2.0 and g[1].month == "February 2011"
    new = customers.new_customers_cumulative(s, "2011-01-01").collect()
    # the NULL customer group first buys in January: counted nowhere
    assert [(r.reg_month, r.regs, r.customer_no_cumulative) for r in new] == [("January", 3, 3)]


def test_unit_economics(spark):
    s = make_sales(spark, [line(1, "A", 1, "2011-01-03", 10.005, 1), line(2, "A", 1, "2011-01-03", 0.0, 2),
                           line(3, "A", 1, "2011-01-03", 5.0, 3, country="Unspecified")])
    assert economics.avg_revenue_per_customer(s, "2011-01-01").first()[0] == 5.0  # 15.005 / 3 = 5.00166
    k4 = economics.avg_revenue_per_customer_by_country(s, "2011-01-01").collect()
    assert [(r.country_name, r.revenue_country, r.customer_number, r.avg_rev_cust_country) for r in k4] == [
        ("Nation_1", 10.01, 2, 5.01)]


def test_null_revenue_sorts_first_as_in_postgresql(spark):
    s = make_sales(spark, [line(1, "A", 1, "2011-01-10", 5.0, 1), line(2, "B", 1, "2011-01-10", None, 1, country="Nowhere"),
                           line(3, "C", 1, "2011-01-10", 7.0, 2)])
    v1 = revenue.item_country_revenue(s, "2011-01-01")
    assert {r.item_description: r.item_rank for r in v1.collect()} == {"B": 1, "C": 2, "A": 3}
    plain = revenue.item_country_revenue(s, "2011-01-01", with_rank=False, exact=True)
    assert [r["items"] for r in revenue.item_revenue(plain).collect()] == ["B", "C", "A"]
    assert revenue.top_items(plain, 1).first()["items"] == "B"
    assert [(r.country_rank, r.country) for r in revenue.country_revenue(plain).collect()] == [(1, "Nowhere"), (2, "Nation_1")]
    assert revenue.top_countries(plain, 1).first().country == "Nowhere"


def test_small_prices_are_not_cut(spark):
    s = make_sales(spark, [line(i, "A", 1, "2011-01-10", 0.00004, 1) for i in range(1000)])
    assert revenue.item_country_revenue(s, "2011-01-01").first().revenue == 0.04
    big = make_sales(spark, [line(i, f"I{i}", 1, "2011-01-10", 9_000_000_000.125, 1) for i in range(2000)])
    plain = revenue.item_country_revenue(big, "2011-01-01", with_rank=False, exact=True)
    assert revenue.country_revenue(plain).first().revenue == 18_000_000_000_250.0
