"""Exact money and percentage arithmetic.

Sums stay DECIMAL and are rounded HALF_UP in decimal.  Averages and
percentages are computed as ``sum / count`` in DECIMAL with the operands'
precision chosen so Spark keeps >= 14 fractional digits before the final
rounding (``avg(decimal)`` keeps only 4 extra digits and can double-round for
large groups).  Values are cast to DOUBLE only for presentation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starling.schemas import MONEY


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_sum(x, digits: int = 2) -> Column:
    """ROUND(SUM(x), digits) in decimal."""
    return F.round(F.sum(_c(x)), digits)


def exact_avg(x, digits: int) -> Column:
    """ROUND(AVG(x), digits) without intermediate rounding; null when no non-null input."""
    # sum(decimal(12,2)) is decimal(22,2); / decimal(20,0) keeps 18 fractional digits
    x = _c(x)
    n = F.count(x)
    return F.round(F.sum(x) / F.nullif(n, F.lit(0)).cast("decimal(20,0)"), digits)


def exact_avg_int(x, digits: int) -> Column:
    """ROUND(AVG(int_col), digits), exact."""
    x = _c(x)
    n = F.count(x)
    return F.round(F.sum(x).cast("decimal(20,0)") / F.nullif(n, F.lit(0)).cast("decimal(20,0)"), digits)


def pct_of_counts(num: Column, den: Column, digits: int) -> Column:
    """ROUND(num * 100.0 / den, digits) for integer counts, exact; null when den = 0."""
    hundred = F.lit(100).cast("decimal(3,0)")
    return F.round(num.cast("decimal(20,0)") * hundred / F.nullif(den, F.lit(0)).cast("decimal(20,0)"), digits)


def ratio_pct(a: Column, b: Column, digits: int) -> Column:
    """ROUND(a / NULLIF(b, 0) * 100, digits) on decimals (zero-safe, ANSI-safe)."""
    return F.round(a * F.lit(100).cast("decimal(3,0)") / F.nullif(b, F.lit(0)), digits)


def money(x) -> Column:
    return _c(x).cast(MONEY)


def lenient_money(x) -> Column:
    """Lenient numeric cast (``to_numeric(errors="coerce")``): unparsable -> null, never an error."""
    return _c(x).try_cast(MONEY)


def as_double(x) -> Column:
    """Presentation cast (after all rounding happened in decimal)."""
    return _c(x).cast("double")
