"""Missing-value semantics of the source pipeline, as Column expressions.

* strict arithmetic: a missing operand makes the result missing;
* skip-null row sums: a missing cell counts as 0 (the divisor stays fixed);
* comparisons with a missing value are False and stay in the denominator;
* "not equal to x" is True for a missing value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_sum(cols) -> Column:
    """a + b + ... with null propagation."""
    return reduce(lambda a, b: a + b, [_c(c) for c in cols])


def skipnull_sum(cols) -> Column:
    """Row sum where null counts as 0 (result is never null)."""
    return reduce(lambda a, b: a + b, [F.coalesce(_c(c).cast("double"), F.lit(0.0)) for c in cols])


def null_count(cols) -> Column:
    """Number of null cells in a row."""
    return reduce(lambda a, b: a + b, [_c(c).isNull().cast("int") for c in cols])


def all_present(cols) -> Column:
    return reduce(lambda a, b: a & b, [_c(c).isNotNull() for c in cols])


def any_missing(cols) -> Column:
    return reduce(lambda a, b: a | b, [_c(c).isNull() for c in cols])


def not_equal_null_aware(c, value) -> Column:
    """x != value where a missing x counts as "not equal" (True)."""
    return ~_c(c).eqNullSafe(F.lit(value))


def share_true(cond: Column) -> Column:
    """Aggregate: share of rows where cond holds; null counts as False."""
    return F.avg(F.coalesce(cond.cast("double"), F.lit(0.0)))
