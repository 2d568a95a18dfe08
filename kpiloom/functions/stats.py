"""Normal and Student-t distribution functions for already-aggregated rows.

SciPy is not assumed.  These run inside Arrow-batched pandas UDFs over the
one or two rows a test produces, never per input row.  The t distribution
uses the regularized incomplete beta function evaluated by its continued
fraction; the quantile inverts the CDF by bisection.
"""

from __future__ import annotations

import math
import sys
from statistics import NormalDist

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship this module's functions to the Python workers by value, so the UDFs
# run even where the package is not installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_STD = NormalDist()


def normal_quantile(p: float) -> float:
    return _STD.inv_cdf(p)


def normal_two_sided_p(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


MAX_TERMS = 100_000
NORMAL_DF = 1e8


def _beta_fraction(a: float, b: float, x: float) -> float:
    """The continued fraction of the incomplete beta function (DLMF 8.17.22),
    1 / (1 + d1 / (1 + d2 / (1 + ...))), by the recurrence of its convergents."""
    top, top_before, bottom, bottom_before, value = 1.0, 1.0, 1.0, 0.0, 1.0
    for k in range(1, MAX_TERMS):
        m = k // 2
        if k % 2:
            d = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        else:
            d = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        top, top_before = top + d * top_before, top
        bottom, bottom_before = bottom + d * bottom_before, bottom
        new = top / bottom
        if abs(new - value) <= 1e-16 * abs(new):
            return 1.0 / new
        value = new
        scale = 1.0 / max(abs(top), abs(bottom))
        top, top_before, bottom, bottom_before = (z * scale for z in (top, top_before, bottom, bottom_before))
    raise ArithmeticError(f"incomplete beta fraction did not converge for a={a}, b={b}, x={x}")


def _lgamma_ratio(a: float, b: float) -> float:
    """ln(Gamma(a + b) / Gamma(a)).  For large a the two lgamma values are
    huge and nearly equal, so use the asymptotic series in 1/a instead."""
    if a < 1e5:
        return math.lgamma(a + b) - math.lgamma(a)
    return (b * math.log(a) + b * (b - 1) / (2 * a)
            + b * (b - 1) * (b - 2) * (3 * b - 1) / (24 * a * a))


def betainc_reg(a: float, b: float, x: float, y: float | None = None) -> float:
    """Regularized incomplete beta I_x(a, b); ``y`` = 1 - x when known more
    precisely than by subtraction (x close to 1)."""
    y = 1.0 - x if y is None else y
    if x <= 0.0:
        return 0.0
    if y <= 0.0:
        return 1.0
    if a >= b:
        ln_beta_inv = _lgamma_ratio(a, b) - math.lgamma(b)
    else:
        ln_beta_inv = _lgamma_ratio(b, a) - math.lgamma(a)
    ln_front = ln_beta_inv + a * math.log(x) + b * math.log(y)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(ln_front) * _beta_fraction(a, b, x) / a
    return 1.0 - math.exp(ln_front) * _beta_fraction(b, a, y) / b


def t_two_sided_p(t: float, df: float) -> float:
    """P(|T| >= |t|) = I_{df/(df+t^2)}(df/2, 1/2); for many degrees of freedom
    the normal tail of the corrected statistic (error of order 1/df^2)."""
    t2 = t * t
    if df > NORMAL_DF:
        return normal_two_sided_p(t * (1.0 - 0.25 / df) / math.sqrt(1.0 + t2 / (2.0 * df)))
    return betainc_reg(df / 2.0, 0.5, df / (df + t2), t2 / (df + t2))


def t_cdf(t: float, df: float) -> float:
    tail = 0.5 * t_two_sided_p(t, df)
    return 1.0 - tail if t > 0 else tail


def t_quantile(p: float, df: float) -> float:
    """Inverse of t_cdf by bisection (monotone, so always converges)."""
    if not 0.0 < p < 1.0:
        raise ValueError("p must be in (0, 1)")
    lo, hi = -1.0, 1.0
    while t_cdf(lo, df) > p:
        lo *= 2.0
    while t_cdf(hi, df) < p:
        hi *= 2.0
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if t_cdf(mid, df) < p:
            lo = mid
        else:
            hi = mid
        if hi - lo < 1e-13 * max(1.0, abs(mid)):
            break
    return 0.5 * (lo + hi)


def _nullable(values) -> pd.Series:
    return pd.Series(pd.array(values, dtype="Float64"))


@F.pandas_udf(T.DoubleType())
def normal_p_udf(z: pd.Series) -> pd.Series:
    """Two-sided normal p-value of a z statistic."""
    return _nullable([None if pd.isna(v) else normal_two_sided_p(float(v)) for v in z])


@F.pandas_udf(T.DoubleType())
def t_p_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided Student-t p-value."""
    return _nullable([None if pd.isna(a) or pd.isna(b) else t_two_sided_p(float(a), float(b))
                      for a, b in zip(t, df)])


@F.pandas_udf(T.DoubleType())
def t_quantile_udf(p: pd.Series, df: pd.Series) -> pd.Series:
    """Student-t quantile."""
    return _nullable([None if pd.isna(a) or pd.isna(b) else t_quantile(float(a), float(b))
                      for a, b in zip(p, df)])
