"""Every registered query against its DuckDB oracle SQL, at sf0.001 (the
driver's correctness gate, run as a test)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import TABLES, rows_of

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_all_queries_match_oracle(spark, duck):
    queries, sqls = E.queries(), E.oracle_sql()
    bad = []
    for name, sql in sqls.items():
        df = queries[name](spark, SF_SMALL)
        rows = [tuple(r) for r in df.collect()]
        res = duck.execute(sql)
        cols = [d[0] for d in res.description]
        if sorted(df.columns) != sorted(cols) or rows_of(df.columns, rows) != rows_of(cols, res.fetchall()):
            bad.append(name)
    assert not bad, bad
