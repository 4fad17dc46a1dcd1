"""Category codes by order of first appearance.

code = 1 + position of the value's first appearance among the distinct
values (ordered by an explicit ``order_by`` column, since a distributed
table has no row order); the missing label is coded 0 but still takes a
position, so codes can skip a number. All columns are fitted in one pass:
the (column, value) pairs are stacked, reduced to their first position
(map-side combined), ranked per column on that small table, and gathered in
a one-row dictionary, a map per column, in which rows look their codes up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MISSING = "Missing"


def fit_first_appearance(df: DataFrame, columns: Sequence[str], order_by: str = "id",
                         missing: str = MISSING) -> DataFrame:
    """Mapping table (column, value, code)."""
    stacked = df.select(F.col(order_by).alias("_o"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit(missing)).alias("value"))
        for c in columns])).alias("s")).select("_o", "s.column", "s.value")
    first = stacked.groupBy("column", "value").agg(F.min("_o").alias("_first"))
    w = Window.partitionBy("column").orderBy("_first", "value")
    return first.select("column", "value",
                        F.when(F.col("value") == missing, F.lit(0)).otherwise(F.row_number().over(w)).alias("code"))


def dictionary(mapping: DataFrame, columns: Sequence[str]) -> Column:
    """The mapping as one value, a struct with a map per column, for use as a
    scalar subquery: the plan holds it once however many columns look things
    up. It is for categories: its size is that of the distinct values."""
    entries = [F.map_from_entries(F.collect_list(F.when(F.col("column") == c, F.struct("value", "code")))).alias(f"m{i}")
               for i, c in enumerate(columns)]
    return mapping.agg(*entries).select(F.struct(*[f"m{i}" for i in range(len(columns))]).alias("d")).scalar()


def apply_mapping(df: DataFrame, mapping: DataFrame, columns: Sequence[str], unseen: int = 0,
                  missing: str = MISSING) -> DataFrame:
    """Replace each column by its code; values absent from the mapping get
    ``unseen``. No join: the codes are looked up in the one-row dictionary."""
    columns = list(columns)
    if not columns:
        return df
    codes = dictionary(mapping.where(F.col("column").isin(columns)), columns)
    place = {c: i for i, c in enumerate(columns)}
    return df.select(*[
        F.coalesce(F.element_at(codes[f"m{place[c]}"], F.coalesce(F.col(c).cast("string"), F.lit(missing))), F.lit(unseen)).cast("int").alias(c)
        if c in place else F.col(c) for c in df.columns])


def encode_per_table(df: DataFrame, columns: Sequence[str], order_by: str = "id") -> DataFrame:
    """Fit and apply on the same table (the source's behaviour: train and
    test each get their own codes)."""
    return apply_mapping(df, fit_first_appearance(df, columns, order_by), columns)


def encode_shared(train: DataFrame, test: DataFrame, columns: Sequence[str], order_by: str = "id",
                  unseen: int = 0) -> tuple[DataFrame, DataFrame]:
    """Fit once on ``train`` and apply to both; values unseen in train -> ``unseen``."""
    m = fit_first_appearance(train, columns, order_by)
    return apply_mapping(train, m, columns, unseen), apply_mapping(test, m, columns, unseen)
