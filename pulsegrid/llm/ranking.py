"""Gapless numbers within a key without putting a key's rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(df: DataFrame, keys: list[str], block: str, order: list[Column], name: str) -> DataFrame:
    """``name``: 0-based position of a row within ``keys``, by (``block``,
    ``order``). ``block`` is a column that is a pure function of the row, so
    rows are numbered inside each (keys, block) and shifted by the number of
    rows of the earlier blocks, a table with one row a block."""
    within = F.row_number().over(Window.partitionBy(*keys, block).orderBy(*order)) - 1
    counts = df.groupBy(*keys, block).agg(F.count(F.lit(1)).alias("__rows"))
    before = F.sum("__rows").over(Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(*keys, block, F.coalesce(before, F.lit(0)).alias("__before"))
    return (df.withColumn("__at", within).join(counts, [*keys, block])
            .withColumn(name, (F.col("__at") + F.col("__before")).cast("long")).drop("__at", "__before"))
