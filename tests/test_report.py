import __spark_entry__ as E
from kpiloom import registry as R
from kpiloom.plans.report import retail_report
from kpiloom.sources.store import cleaned_sales

from .conftest import SF_SMALL


def _rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_report_equals_registered_queries(spark):
    sales = cleaned_sales(spark, SF_SMALL)
    report = retail_report(sales, R.START, quarters=[f"Q{i} {R.QUARTER_YEAR}" for i in range(1, 5)],
                           bins=R.REV_BINS, revenue_cuts=R.REV_CUTS)
    q = E.queries()
    assert len(report) == 38
    for name, df in report.items():
        assert _rows(df) == _rows(q[name](spark, SF_SMALL)), name
