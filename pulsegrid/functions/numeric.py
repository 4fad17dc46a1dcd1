"""Numeric helpers: ANSI-safe division, half-even rounding, corrected moments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a, b) -> Column:
    """a / b, null when b is 0 or null (ANSI mode would raise)."""
    return F.try_divide(_c(a), _c(b))


def half_even(c, scale: int = 0) -> Column:
    """Banker's rounding (numpy/pandas round)."""
    return F.bround(_c(c), scale)


def corrected_skewness(c) -> Column:
    """Aggregate: sample skewness with the small-sample correction
    G1 = sqrt(n(n-1))/(n-2) * g1; null for n < 3, 0 for a constant group."""
    x = _c(c)
    n = F.count(x).cast("double")
    g1 = F.skewness(x)
    return (F.when(n < 3, F.lit(None).cast("double"))
            .when(F.var_pop(x) == 0, F.lit(0.0))
            .otherwise(F.sqrt(n * (n - 1)) / (n - 2) * g1))


def corrected_kurtosis(c) -> Column:
    """Aggregate: sample excess kurtosis with the small-sample correction
    G2 = ((n+1) g2 + 6)(n-1)/((n-2)(n-3)); null for n < 4, 0 for a constant group."""
    x = _c(c)
    n = F.count(x).cast("double")
    g2 = F.kurtosis(x)
    return (F.when(n < 4, F.lit(None).cast("double"))
            .when(F.var_pop(x) == 0, F.lit(0.0))
            .otherwise(((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3))))


def guarded_cv(sd: Column, mean: Column) -> Column:
    """std/mean, 0 when the mean is exactly 0 (a missing mean stays missing)."""
    return F.when(mean.eqNullSafe(F.lit(0.0)), F.lit(0.0)).otherwise(F.try_divide(sd, mean))
