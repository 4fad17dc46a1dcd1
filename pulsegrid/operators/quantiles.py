"""Exact, linearly interpolated quantiles per group, and equal-frequency buckets.

Spark's exact ``percentile`` aggregate keeps every distinct value of a group
in one task; ``approx_percentile`` is not exact. Here a histogram is refined
where a target rank lies:

1. collapse duplicates: ``(group, value) -> multiplicity`` (map-side combine,
   so a value repeated a billion times is one row);
2. every value gets a 64-bit key that never falls with the value
   (``order_key``), a pure function of it, so all uses of the frame agree
   whatever plan Spark picks;
3. count by the key's leading digits; the cells that hold a target rank, a
   few per group, are split by further digits, again and again
   (``CELL_SHIFTS``);
4. the values of the last cells, at most 2 ** (last shift) each however
   narrow or skewed the column is, are ranked by a window per cell; one
   aggregate per group interpolates ``x[lo] + (x[lo+1] - x[lo]) * frac``
   (numpy's "linear").
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _lerp(a: Column, b: Column, t: Column) -> Column:
    # numpy's lerp: from the nearer end, exact at both ends
    return F.when((a == b) | (t == 0), a).when(t >= 0.5, b - (b - a) * (F.lit(1.0) - t)).otherwise(a + (b - a) * t)


CELL_SHIFTS = (44, 22)  # low bits of the key that a cell of each round leaves open


def order_key(v: Column) -> Column:
    """A long that never falls with a double: exponent and mantissa of its
    size, with its sign; NaN last."""
    size = F.abs(v)
    exponent = F.greatest(F.floor(F.log2(size)), F.lit(-1000))
    mantissa = F.floor((size * F.pow(F.lit(2.0), -exponent) - 1) * float(1 << 52))
    key = ((exponent + 1002) * (1 << 52) + mantissa).cast("long")
    top = (1 << 63) - 1
    found = (F.when(F.isnan(v), F.lit(top)).when(v == float("inf"), F.lit(top - 1)).when(v == float("-inf"), F.lit(1 - top))
             .when(v == 0, F.lit(0)).when(v > 0, key).otherwise(-key).cast("long"))
    # never null, so joins on its digits push no test of it below the exchange that their sides share
    return F.coalesce(found, F.lit(0).cast("long"))


def _covered(probs: Sequence[float], low: Column, rows: Column, n: Column) -> Column:
    """Do ranks low .. low + rows - 1 of n hold a rank that a quantile needs?"""
    found = F.lit(False)
    for p in probs:
        for rank in _ranks(p, n):
            found = found | ((low <= rank) & (rank < low + rows))
    return found


def _ranks(p: float, n: Column) -> tuple[Column, Column]:
    at = F.floor(F.lit(float(p)) * (n - 1).cast("double"))
    return at, F.least(at + 1, n - 1)


def exact_quantiles(df: DataFrame, keys, value: str, probs: Sequence[float],
                    names: Sequence[str] | None = None, count_name: str | None = None,
                    cell_shifts: Sequence[int] = CELL_SHIFTS) -> DataFrame:
    """One row per group: ``names[i]`` = quantile at ``probs[i]`` of non-null ``value``.

    ``keys`` may be empty for a global quantile. Groups without values are absent.
    """
    keys = _keys(keys)
    names = list(names) if names is not None else [f"q_{i}" for i in range(len(probs))]
    # null keys form no group; said here, all uses of the frame have the same filters and share one exchange
    v = df.select(*keys, F.col(value).cast("double").alias("_v")).where(
        reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], F.col("_v").isNotNull()))
    distinct = v.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_m"))
    values = distinct.select("*", order_key(F.col("_v")).alias("_k"))
    rows, within = values, list(keys)  # rows of the cells that are still open, and what tells the cells apart
    for i, shift in enumerate(cell_shifts):
        cell = f"_c{i}"
        known = ["_low", "_n"] if i else []
        counts = rows.groupBy(*within, *known, F.shiftright("_k", shift).alias(cell)).agg(F.sum("_m").alias("_rows"))
        w = Window.partitionBy(*within)
        before = F.coalesce(F.sum("_rows").over(w.orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        counts = counts.select(*within, cell, "_rows", (F.col("_low") + before if i else before).alias("_low"),
                               (F.col("_n") if i else F.sum("_rows").over(w)).alias("_n"))
        hold = counts.where(_covered(probs, F.col("_low"), F.col("_rows"), F.col("_n"))).drop("_rows")
        within = [*within, cell]
        digits = [F.shiftright("_k", s).alias(f"_c{j}") for j, s in enumerate(cell_shifts[:i + 1])]
        rows = values.select("*", *digits).join(hold, within)
    inside = F.sum("_m").over(Window.partitionBy(*within).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.select(*keys, "_v", "_m", "_n", (F.col("_low") + inside - F.col("_m")).alias("_low"))

    def at(rank):
        return F.max(F.when((F.col("_low") <= rank) & (rank < F.col("_low") + F.col("_m")), F.col("_v")))

    aggs = [F.max("_n").alias("_n")]
    for i, p in enumerate(probs):
        low, high = _ranks(p, F.col("_n"))
        aggs += [at(low).alias(f"_a{i}"), at(high).alias(f"_b{i}")]
    g = rows.groupBy(*keys).agg(*aggs).where(F.col("_n").isNotNull())
    out = [*keys]
    for i, p in enumerate(probs):
        vi = F.lit(float(p)) * (F.col("_n") - 1).cast("double")
        t = vi - F.floor(vi)
        out.append(_lerp(F.col(f"_a{i}"), F.col(f"_b{i}"), t).alias(names[i]))
    if count_name:
        out.append(F.col("_n").alias(count_name))
    return g.select(*out)


def array_quantile(values: Column, p: float) -> Column:
    """The same quantile of an ascending array without nulls; null if it is empty."""
    n = F.size(values)
    at = F.lit(float(p)) * (n - 1).cast("double")
    low, high = _ranks(p, n)
    return F.when(n > 0, _lerp(F.get(values, low.cast("int")), F.get(values, high.cast("int")), at - F.floor(at)))


def qcut_bucket(x: Column, edges: Sequence[Column]) -> Column:
    """1-based equal-frequency bucket of x given ascending quantile edges.

    Intervals are (e[i-1], e[i]] with the minimum edge included in bucket 1;
    duplicate edges are dropped first (a repeated edge is counted once), so
    ties share a bucket (unlike ``ntile``). Null x -> null; with fewer than
    two distinct edges there is no interval and every bucket is null.
    """
    below = None
    n_distinct = F.lit(1)
    for i, e in enumerate(edges):
        new = (e < x) if i == 0 else ((e < x) & (e != edges[i - 1]))
        term = F.coalesce(new.cast("int"), F.lit(0))
        below = term if below is None else below + term
        if i:
            n_distinct = n_distinct + F.coalesce((e != edges[i - 1]).cast("int"), F.lit(0))
    return F.when(x.isNotNull() & (n_distinct >= 2), F.greatest(F.lit(1), below))


def decile_probs(q: int) -> list[float]:
    """Edge probabilities 0, 1/q, ..., 1 as numpy's linspace gives them."""
    return [i / q for i in range(q + 1)]
