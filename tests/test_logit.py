"""Logit models by Newton steps against an independent fit and the closed form."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiloom.operators.experiment import logit_test
from kpiloom.operators.logit import logit_model


def data(seed, n, levels):
    rnd = np.random.default_rng(seed)
    cols = [rnd.integers(0, k, n) for k in levels]
    line = -0.7 + sum((i + 1) * 0.3 * (c == c.max()) - 0.4 * (c == 1) for i, c in enumerate(cols))
    y = (rnd.random(n) < 1 / (1 + np.exp(-line))).astype(int)
    return cols, y


def independent(cols, y):
    """Coefficients and errors by iterated least squares over single rows."""
    x = np.column_stack([np.ones(len(y))] + [(c == v).astype(float) for c in cols for v in sorted(set(c))[1:]])
    b = np.zeros(x.shape[1])
    for _ in range(60):
        m = 1 / (1 + np.exp(-x @ b))
        h = x.T @ (x * (m * (1 - m))[:, None])
        b = b + np.linalg.solve(h, x.T @ (y - m))
    return b, np.sqrt(np.diag(np.linalg.inv(h)))


def frame(spark, cols, y):
    rows = [(*(f"l{c[i]}" for c in cols), int(y[i])) for i in range(len(y))]
    names = [f"f{i} string" for i in range(len(cols))]
    return spark.createDataFrame(rows, ", ".join(names) + ", hit int").repartition(4)


@pytest.mark.parametrize("levels", [(3,), (2, 2), (3, 4)])
def test_equals_an_independent_fit(spark, levels):
    cols, y = data(len(levels), 900, levels)
    got = logit_model(frame(spark, cols, y), "hit", [f"f{i}" for i in range(len(levels))]).collect()
    b, se = independent(cols, y)
    assert [r.term for r in got] == ["(Intercept)"] + [f"f{i}l{v}" for i, k in enumerate(levels) for v in range(1, k)]
    assert np.allclose([r.estimate for r in got], b, atol=1e-6) and np.allclose([r.std_error for r in got], se, atol=1e-6)
    assert all(0 <= r.p_value <= 1 for r in got)


def test_equals_the_closed_form_for_two_levels(spark):
    cols, y = data(7, 600, (2,))
    df = frame(spark, cols, y).withColumn("condition", F.when(F.col("f0") == "l0", "tips").otherwise("tools"))
    one = logit_model(df, "hit", ["condition"], digits=6).collect()
    assert one == logit_test(df, "hit", digits=6).collect()


def test_nulls_separation_and_single_levels(spark):
    rows = [("a", 1), ("a", 0), ("a", None), ("b", 1), ("b", 1), (None, 0), ("b", None)] * 5
    df = spark.createDataFrame(rows, "f string, y int")
    assert [r.estimate for r in logit_model(df, "y", ["f"]).collect()] == [None, None]      # b never fails
    mixed = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), ("b", 0), ("b", 0)] * 3, "f string, y int")
    assert all(r.estimate is not None for r in logit_model(mixed, "y", ["f"]).collect())
    same = logit_model(mixed.withColumn("g", F.col("f")), "y", ["f", "g"]).collect()          # g adds nothing to f
    assert len(same) == 3 and all(r.estimate is None for r in same)
    with pytest.raises(ValueError, match="needs two"):
        logit_model(df.where("f = 'a'"), "y", ["f"])
