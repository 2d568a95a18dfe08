import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kpiloom.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ck = tempfile.mkdtemp(prefix="kl-test-ckpt-")
    s = get_spark("local[*]", app="kpiloom-tests", shuffle_partitions=8,
                  extra={"spark.checkpoint.dir": ck, "spark.driver.memory": "4g"})
    yield s
    s.stop()


SALES_DDL = ("InvoiceNo string, StockCode string, Description string, Quantity int, InvoiceDate date, "
             "UnitPrice double, CustomerID bigint, Country string")


def make_sales(spark, rows):
    """Cleaned-style sales rows -> DataFrame with rev (tuples in SALES_DDL order; dates as text)."""
    from kpiloom.functions.numeric import line_revenue
    fixed = [tuple(dt.date.fromisoformat(v) if i == 4 and isinstance(v, str) else v for i, v in enumerate(r))
             for r in rows]
    return spark.createDataFrame(fixed, SALES_DDL).withColumn("rev", line_revenue())


def line(inv, desc, qty, date, price, cust, country="Nation_1", stock="1"):
    return (str(inv), stock, desc, qty, date, price, cust, country)
