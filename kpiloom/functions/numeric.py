"""Exact money arithmetic.

Line revenue is a decimal, so every sum is independent of row order and
partitioning, and rounding is decimal rounding (half away from zero), as
PostgreSQL's numeric does.  A rounded quotient is computed with integral
division (``div``), so no intermediate quotient is itself rounded.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,8)"


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def line_revenue(price="UnitPrice", qty="Quantity") -> Column:
    """UnitPrice * Quantity as a decimal with eight places (a line above 10**10 raises)."""
    return (_c(price) * _c(qty)).cast(MONEY)


def round_to_double(col, digits: int) -> Column:
    """round(numeric, digits), exposed as double."""
    return F.round(_c(col), digits).cast("double")


def int_div(a, b) -> Column:
    """Integral division that truncates toward zero; exact for decimals (SQL ``div``)."""
    return F.call_function("div", _c(a), _c(b))


def exact_round_div(num, den, digits: int) -> Column:
    """round(num / den, digits), half away from zero, exactly; NULL unless den > 0.

    ``num`` may be an integer or a decimal with at most eight places; ``den``
    an integer: sign(n) * ((2|n|*10^k + d) div 2d) / 10^k.
    """
    n = _c(num).cast("decimal(28,8)")
    d = _c(den).cast("decimal(20,0)")
    top = F.abs(n) * F.lit(Decimal(2 * 10 ** digits)) + d
    whole = F.signum(n).cast("bigint") * int_div(top, d * F.lit(Decimal(2)))
    q = whole.cast("decimal(38,0)") * F.lit(Decimal(1).scaleb(-digits))
    return F.when(d > 0, q.cast("double"))


def trunc_toward_zero(col, unit: int) -> Column:
    """PostgreSQL trunc(x, -k) with unit = 10**k, as bigint: -500 -> 0, -1500 -> -1000."""
    return int_div(_c(col), F.lit(unit)) * F.lit(unit)
