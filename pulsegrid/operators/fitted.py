"""Fitted global statistics.

A global statistic (scaler mean / std, quantile edges, histogram range,
class totals) is one aggregate row. ``fitted`` keeps it in the plan as a
scalar subquery, so nothing runs before the query does; ``fit_row`` runs one
job where the driver needs the values (thresholds, label sets) and only that
single row reaches it, never the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


def fit_row(stats: DataFrame) -> Row:
    """Collect a statistics frame that is one row by construction."""
    rows = stats.limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected exactly one statistics row, got {len(rows)}")
    return rows[0]


def fitted(stats: DataFrame) -> dict[str, Column]:
    """The columns of a one-row statistics frame, as expressions for use on
    any other frame."""
    row = stats.select(F.struct(*stats.columns).alias("row")).scalar()
    return {c: row[c] for c in stats.columns}
