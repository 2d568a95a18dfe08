from kpiloom.operators import profile

from .conftest import line, make_sales


def test_profile_empty_and_counts(spark):
    empty = make_sales(spark, [])
    r = profile.non_null_counts(empty).first()
    assert all(v is None for v in r)  # SUM over no rows is NULL
    assert profile.row_count(empty).first().n == 0
    s = make_sales(spark, [line(1, "A", 1, "2011-01-02", 1.0, None), line(2, "B", 1, "2010-12-02", 1.0, 7)])
    r = profile.non_null_counts(s).first()
    assert r.customer_not_null_count == 1 and r.invoice_not_null_count == 2
    d = profile.distinct_counts(s, "2011-01-01").first()
    assert (d.countries, d.customers, d.description_items) == (1, 0, 1)
    types = dict(profile.column_types(s).collect())
    assert types["Quantity"] == "integer" and types["rev"] == "numeric" and types["InvoiceDate"] == "date"
