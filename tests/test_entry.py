import __spark_entry__ as E
from kpiloom.registry import QUERIES as ANALYSES

from .conftest import SF_SMALL


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.columns == ["months", "revenue", "growth_rate"]
    assert df.count() > 0
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(ANALYSES) <= set(q) and set(ANALYSES) <= set(o)


def test_every_query_runs_small(spark):
    for name, fn in ANALYSES.items():
        df = fn(spark, SF_SMALL)
        assert df.columns, name
        df.limit(1).collect()


def test_udfs_run_without_package_on_worker_path(tmp_path):
    """Python workers start outside the repository: the p-value UDFs must not
    need the package importable there (they are shipped by value)."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "run.py"
    script.write_text(
        "import sys\n"
        f"sys.path.insert(0, {repo!r})\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "import __spark_entry__ as E\n"
        f"rows = E.queries()['X9_welch_test_p'](spark, {SF_SMALL!r}).collect()\n"
        "print('P_VALUE', rows[0].p_value)\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=300)
    assert "P_VALUE" in out.stdout, out.stderr[-2000:]
