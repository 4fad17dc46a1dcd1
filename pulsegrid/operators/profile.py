"""Profiling operators: missingness, dense group counts, shares, buckets,
histograms, correlations. Each is one or two aggregations; the inputs are
never collected, only their (small) aggregates are reshaped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.operators.fitted import fitted
from pulsegrid.operators.quantiles import exact_quantiles


def _lit_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


# ------------------------------------------------------------ missingness
def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(field, missing_pct) for every column, one aggregate pass, largest first."""
    cols = list(columns or df.columns)
    one = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(f"_{i}") for i, c in enumerate(cols)])
    long = one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(f"_{i}").alias("missing_pct")) for i, c in enumerate(cols)
    ])).alias("s")).select("s.field", "s.missing_pct")
    return long.orderBy(F.desc("missing_pct"), "field")


def missing_triage(report: DataFrame, remove_above: float = 50.0, impute_above: float = 10.0) -> DataFrame:
    """Adds ``action``: remove (> 50), impute (10 < x < 50), keep (< 10); a
    share of exactly 10 or 50 lands in no band (null), as in the source."""
    m = F.col("missing_pct")
    act = (F.when(m > remove_above, "remove")
           .when((m > impute_above) & (m < remove_above), "impute")
           .when(m < impute_above, "keep"))
    return report.withColumn("action", act)


def transpose_report(report: DataFrame, fields: Sequence[str], field: str = "field", value: str = "missing_pct") -> DataFrame:
    """The report turned on its side: one row, one column per field (null
    where the report has none). The fields are given, so no job looks for
    them, and the aggregate holds one value per field whatever the report's
    size; of a field's repeated rows the largest value counts."""
    return report.groupBy().pivot(field, list(fields)).agg(F.max(value)).select(*[F.col(f"`{f}`") for f in fields])


# ----------------------------------------------------------- dense groups
def dense_counts(df: DataFrame, category: str, domain: Sequence, key: str | None = None,
                 count_col: str = "id", name: str = "count") -> DataFrame:
    """Count of non-null ``count_col`` per (category, key) with every domain
    value present for every observed key (count 0 when absent), like a
    group-by over an ordered category. Rows whose category is outside the
    domain or whose key is null are not counted."""
    src = df.where(F.col(category).isin(list(domain)))
    keys = [key] if key else []
    if key:
        src = src.where(F.col(key).isNotNull())
    counts = src.groupBy(category, *keys).agg(F.count(count_col).alias(name))
    if key:
        grid = (df.where(F.col(key).isNotNull()).select(key).distinct()
                .select(key, F.explode(_lit_array(domain)).alias(category)))
    else:
        grid = df.sparkSession.range(1).select(F.explode(_lit_array(domain)).alias(category))
    out = grid.join(counts, [category, *keys], "left")
    return out.select(category, *keys, F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name))


def share_within(df: DataFrame, value: str, within: Sequence[str] | None = None, name: str = "percentage") -> DataFrame:
    """value / sum(value) * 100 within the ``within`` groups (all rows if None).
    The input is an already aggregated (small) table."""
    w = Window.partitionBy(*within) if within else Window.partitionBy()
    return df.withColumn(name, F.try_divide(F.col(value).cast("double"), F.sum(value).over(w)) * 100)


def class_distribution(df: DataFrame, category: str, domain: Sequence, count_col: str = "id") -> DataFrame:
    """Count and percentage of total per domain value (dense)."""
    return share_within(dense_counts(df, category, domain, None, count_col), "count")


def distribution_tables(df: DataFrame, variable: str, category: str, domain: Sequence,
                        count_col: str = "id") -> DataFrame:
    """(category, variable, count, percentage within variable) on the dense grid,
    plus the per-variable total as ``variable_count`` (the first of the three tables)."""
    dense = dense_counts(df, category, domain, variable, count_col)
    per_var = df.where(F.col(variable).isNotNull()).groupBy(variable).agg(F.count(count_col).alias("variable_count"))
    out = share_within(dense, "count", [variable])
    return out.join(per_var, variable, "left")


# ------------------------------------------------------ group aggregates
def target_audit(df: DataFrame, target: str, total: str, key: str = "id") -> DataFrame:
    """Per target value (nulls dropped): count of ids, min / max / mean total."""
    return (df.where(F.col(target).isNotNull()).groupBy(target)
            .agg(F.count(key).alias("id_count"), F.min(total).alias("total_min"),
                 F.max(total).alias("total_max"), F.avg(total).alias("total_mean")))


def split_median(df: DataFrame, split_col: str, value: str, zero=0, scale: int = 2) -> DataFrame:
    """Median of ``value`` on rows with split == zero and with split != zero
    (a missing split counts as "not zero"), rounded half-even."""
    part = F.when(F.col(split_col).eqNullSafe(F.lit(zero)), F.lit("zero")).otherwise(F.lit("not_zero"))
    q = exact_quantiles(df.withColumn("part", part), ["part"], value, [0.5], names=["median"])
    return q.select("part", F.bround("median", scale).alias("median"))


# ------------------------------------------------- buckets and histograms
def quantile_buckets(df: DataFrame, variable: str, q: int, duplicates: str = "raise",
                     name: str | None = None) -> DataFrame:
    """Equal-frequency bucket (1..q) of ``variable`` over the whole table, with
    the global quantile edges as a scalar subquery. Duplicate edges
    are dropped (``duplicates='drop'``) or make the query fail ('raise')."""
    name = name or f"{variable}_bucket"
    probs = [i / q for i in range(q + 1)]
    edges = exact_quantiles(df, [], variable, probs, names=[f"_e{i}" for i in range(q + 1)])
    distinct = F.array_distinct(F.array(*[F.col(f"_e{i}") for i in range(q + 1)]))
    if duplicates == "raise":
        distinct = F.when(F.size(distinct) <= q, F.raise_error(F.lit("Bin edges must be unique")).cast("array<double>")).otherwise(distinct)
    elif duplicates != "drop":
        raise ValueError("duplicates must be 'raise' or 'drop'")
    told = df.withColumn("_ends", fitted(edges.select(distinct.alias("edges")))["edges"])
    x, ends = F.col(variable), F.col("_ends")
    # (e[i - 1], e[i]], the smallest value in bucket 1; one edge makes no interval
    bucket = F.when(x.isNotNull() & (F.size(ends) >= 2), F.greatest(F.lit(1), F.size(F.filter(ends, lambda e: e < x))))
    out = told.withColumn(name, bucket)
    return (out.withColumn(f"{name}_lo", F.try_element_at(ends, F.col(name)))
               .withColumn(f"{name}_hi", F.try_element_at(ends, F.col(name) + 1)).drop("_ends"))


def bucket_report(df: DataFrame, variable: str, q: int, target: str, category: str, domain: Sequence,
                  count_col: str = "id") -> DataFrame:
    """Per bucket: mean target, and the bucket x class counts (dense) as
    columns, in one aggregate with a counter per class."""
    b = quantile_buckets(df, variable, q)
    bname = f"{variable}_bucket"
    counters = [F.count(F.when(F.col(category) == v, F.col(count_col))).alias(f"n_{i}") for i, v in enumerate(domain)]
    return b.where(F.col(bname).isNotNull()).groupBy(bname, f"{bname}_lo", f"{bname}_hi").agg(F.avg(target).alias("target_mean"), *counters)


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram of non-null values: (bin, lo, hi, count); all bins
    present; the maximum falls into the last bin."""
    v = df.select(F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    rng = v.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    r = fitted(rng)
    lo, hi = r["_lo"], r["_hi"]
    width = (hi - lo) / bins
    b = (v.select(F.when(hi == lo, F.lit(1))
                  .otherwise(F.least(F.lit(bins), F.floor((F.col("_x") - lo) / width).cast("int") + 1))
                  .alias("bin"))
         .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    grid = rng.select("_lo", "_hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    out = grid.join(b, "bin", "left").select(
        "bin", (F.col("_lo") + (F.col("bin") - 1) * (F.col("_hi") - F.col("_lo")) / bins).alias("lo"),
        (F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / bins).alias("hi"),
        F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))
    return out


# ----------------------------------------------------------- correlation
def correlation_table(df: DataFrame, columns: Sequence[str], target: str, scale: int = 2) -> DataFrame:
    """(field, corr, corr_pct): pairwise-complete Pearson correlation with the
    target in one aggregate pass; corr_pct = half-even round(corr, 2) * 100."""
    one = df.agg(*[F.corr(c, target).alias(f"_{i}") for i, c in enumerate(columns)])
    long = one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(f"_{i}").alias("corr")) for i, c in enumerate(columns)
    ])).alias("s")).select("s.field", "s.corr")
    return long.withColumn("corr_pct", F.bround("corr", scale) * 100)
