"""Ordinal metrics and prediction post-processing as aggregations.

Quadratic weighted kappa needs only per-row class indices: with i = index
of the true label and j = index of the prediction (rank in the union of
labels present), and N rows,

    sum w*O = sum (i - j)^2
    sum w*E = sum i^2 + sum j^2 - 2 (sum i)(sum j) / N

so kappa = 1 - sum w*O / sum w*E is one aggregate (grouped by fold if
wanted); the union-of-labels index comes from a tiny distinct table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.operators.fitted import fit_row

# The source's starting thresholds for the 0..3 classes.
DEFAULT_THRESHOLDS = (0.5, 1.5, 2.5)


def threshold_round(score: Column, thresholds: Sequence = DEFAULT_THRESHOLDS) -> Column:
    """0 if s < t0, 1 if s < t1, 2 if s < t2, else 3 (a missing score -> 3)."""
    t0, t1, t2 = [F.lit(t) if not isinstance(t, Column) else t for t in thresholds]
    return (F.when(score < t0, 0).when(score < t1, 1).when(score < t2, 2).otherwise(3)).cast("int")


def half_even_class(score: Column) -> Column:
    """Rounded regression output as int (numpy rounds half to even)."""
    return F.bround(score, 0).cast("int")


def _label_index(df: DataFrame, y: str, p: str) -> DataFrame:
    labels = df.select(F.col(y).alias("_l")).union(df.select(F.col(p).alias("_l"))).where(F.col("_l").isNotNull()).distinct()
    # tiny table (number of classes): a global window on it is fine
    return labels.select("_l", (F.dense_rank().over(Window.orderBy("_l")) - 1).alias("_idx"))


def qwk(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = (), name: str = "qwk") -> DataFrame:
    """Quadratic weighted kappa (per ``by`` group); null when expected disagreement is 0.
    Rows are reduced to a (y, p) count table first; the labels' ranks join that table."""
    by = list(by)
    idx = _label_index(df, y, p)
    counts = (df.where(F.col(y).isNotNull() & F.col(p).isNotNull()).groupBy(*by, F.col(y).alias("_y"), F.col(p).alias("_p"))
              .agg(F.count(F.lit(1)).alias("_n")))
    d = (counts.join(idx.select(F.col("_l").alias("_y"), F.col("_idx").alias("_i")), "_y")
         .join(idx.select(F.col("_l").alias("_p"), F.col("_idx").alias("_j")), "_p"))
    i, j, m = F.col("_i").cast("double"), F.col("_j").cast("double"), F.col("_n").cast("double")
    n = F.sum(m)
    num = F.sum(m * (i - j) * (i - j))
    den = F.sum(m * i * i) + F.sum(m * j * j) - 2 * F.sum(m * i) * F.sum(m * j) / n
    return d.groupBy(*by).agg((F.lit(1.0) - F.try_divide(num, den)).alias(name), F.coalesce(n, F.lit(0)).cast("long").alias("n"))


def cohen_kappa(df: DataFrame, y: str = "y", p: str = "p", name: str = "kappa") -> DataFrame:
    """Unweighted kappa: 1 - (1 - po) / (1 - pe), pe from the class marginals
    (a per-class table reduced to one fitted number)."""
    d = df.where(F.col(y).isNotNull() & F.col(p).isNotNull())
    cy = d.groupBy(F.col(y).alias("_c")).agg(F.count(F.lit(1)).alias("_ny"))
    cp = d.groupBy(F.col(p).alias("_c")).agg(F.count(F.lit(1)).alias("_np"))
    s_pe = F.lit(fit_row(cy.join(cp, "_c").agg(F.sum(F.col("_ny") * F.col("_np")).cast("double").alias("s")))["s"] or 0.0)
    n = F.count(F.lit(1)).cast("double")
    po = F.avg((F.col(y) == F.col(p)).cast("double"))
    return d.agg((F.lit(1.0) - F.try_divide(F.lit(1.0) - po, F.lit(1.0) - s_pe / (n * n))).alias(name))


def confusion(df: DataFrame, y: str = "y", p: str = "p", classes: Sequence[int] = (0, 1, 2, 3)) -> DataFrame:
    """Dense confusion counts (y, p, count) over the class grid, which is
    ``classes`` and any other label that occurs: no row is left out."""
    counts = df.where(F.col(y).isNotNull() & F.col(p).isNotNull()).groupBy(
        F.col(y).alias("y"), F.col(p).alias("p")).agg(F.count(F.lit(1)).alias("count"))
    fixed = df.sparkSession.createDataFrame([(c,) for c in classes], "c int")
    seen = fixed.union(counts.select("y")).union(counts.select("p")).distinct()
    # labels x labels, as an equi-join on one constant key: label-sized, not row-sized
    one = seen.select(F.lit(1).alias("_k"), F.col("c").alias("y"))
    grid = one.join(one.withColumnRenamed("y", "p"), "_k").drop("_k")
    return grid.join(counts, ["y", "p"], "left").select(
        "y", "p", F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def class_report(df: DataFrame, y: str = "y", p: str = "p", classes: Sequence[int] = (0, 1, 2, 3)) -> DataFrame:
    """Per class: support, precision, recall, F1 (null on a zero denominator)."""
    c = confusion(df, y, p, classes)
    per = c.groupBy(F.col("y").alias("cls")).agg(
        F.sum("count").alias("support"), F.sum(F.when(F.col("y") == F.col("p"), F.col("count"))).alias("tp"))
    pred = c.groupBy(F.col("p").alias("cls")).agg(F.sum("count").alias("predicted"))
    r = per.join(pred, "cls")
    prec = F.try_divide(F.col("tp").cast("double"), F.col("predicted"))
    rec = F.try_divide(F.col("tp").cast("double"), F.col("support"))
    return r.select("cls", F.col("support").cast("long").alias("support"), prec.alias("precision"),
                    rec.alias("recall"), F.try_divide(2 * prec * rec, prec + rec).alias("f1"))


def regression_summary(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Accuracy and mean absolute error in one pass."""
    d = df.where(F.col(y).isNotNull() & F.col(p).isNotNull())
    return d.agg(F.avg((F.col(y) == F.col(p)).cast("double")).alias("accuracy"),
                 F.avg(F.abs(F.col(y) - F.col(p))).alias("mae"), F.count(F.lit(1)).alias("n"))


def majority_vote(cols: Sequence[str]) -> Column:
    """Most common vote per row, smallest on ties. For two voters this is
    ``least(a, b)``; for more, a small per-row array reduction."""
    if len(cols) == 2:
        a, b = F.col(cols[0]), F.col(cols[1])
        return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(F.least(a, b))
    arr = F.filter(F.array(*[F.col(c) for c in cols]), lambda v: v.isNotNull())
    counted = F.transform(arr, lambda v: F.struct(F.size(F.filter(arr, lambda u: u == v)).alias("n"), (-v).alias("nv")))
    best = F.array_max(counted)
    return (-best.getField("nv")).cast("int")


def threshold_grid(df: DataFrame, y: str = "y", score: str = "score", step: float = 0.1,
                   lo: float = 0.0, hi: float = 4.0, classes: Sequence[int] = (0, 1, 2, 3)) -> DataFrame:
    """Best ordered thresholds t1 < t2 < t3 on the grid lo + k*step for QWK.

    Scores are put in grid cells once (cell = number of grid points at or
    below the score, by the same comparison as ``threshold_round``); the data
    is reduced to cumulative counts per (cell, class), so each candidate needs
    three equi-joins on the grid index, never a pass over the rows. The kappa
    is that of ``qwk``: ranks among the labels seen or predicted by the
    candidate. Ties go to the smallest triple. A missing score counts as above
    every threshold (class 3).
    """
    K = int(round((hi - lo) / step))
    s = F.greatest(F.lit(lo - step), F.least(F.lit(hi + step), F.col(score).cast("double")))
    near = F.floor((s - lo) / step).cast("int")
    # the division may land beside a grid point; the comparison decides
    at = near + (s >= F.lit(lo) + (near + 1) * F.lit(step)).cast("int") - (s < F.lit(lo) + near * F.lit(step)).cast("int")
    cell = F.when(F.col(score).isNull(), F.lit(K + 1)).otherwise(F.least(F.lit(K + 1), F.greatest(F.lit(0), at + 1)))
    d = df.where(F.col(y).isNotNull()).select(F.col(y).cast("int").alias("_y"), cell.alias("_cell"))
    counts = d.groupBy("_cell").agg(*[F.count(F.when(F.col("_y") == c, 1)).alias(f"_n{c}") for c in classes])
    # cum_c(k) = rows of class c whose score is below grid point k (cells < k+1)
    grid = df.sparkSession.range(0, K + 1).select(F.col("id").cast("int").alias("k"))
    # grid-sized table: a global running sum over it is bounded by the grid
    cells = df.sparkSession.range(0, K + 2).select(F.col("id").cast("int").alias("_cell")).join(counts, "_cell", "left")
    run = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    cum = cells.select(F.col("_cell").alias("k"), *[F.coalesce(F.sum(f"_n{c}").over(run), F.lit(0)).alias(f"c{c}")
                                                    for c in classes])
    tot_row = fit_row(counts.agg(*[F.coalesce(F.sum(f"_n{c}"), F.lit(0)).alias(f"N{c}") for c in classes]))
    k1 = grid.select(F.col("k").alias("k1"))
    cand = (k1.select("k1", F.explode(F.sequence(F.col("k1") + 1, F.lit(K))).alias("k2"))
            .where(F.col("k2") <= K)
            .select("k1", "k2", F.explode(F.sequence(F.col("k2") + 1, F.lit(K))).alias("k3"))
            .where(F.col("k3") <= K))
    for t in ("k1", "k2", "k3"):
        cand = cand.join(cum.select(F.col("k").alias(t), *[F.col(f"c{c}").alias(f"{t}_c{c}") for c in classes]), t)
    # O[c][j] for predicted class j = 0..3 from the cumulative counts
    O = {}
    for c in classes:
        a, b, cc, n = (F.col(f"k1_c{c}"), F.col(f"k2_c{c}"), F.col(f"k3_c{c}"), F.lit(tot_row[f"N{c}"]))
        O[c] = [a, b - a, cc - b, n - cc]
    N = sum(F.lit(tot_row[f"N{c}"]) for c in classes).cast("double")
    row_m = {c: sum(O[c][j] for j in range(4)) for c in classes}
    col_m = [sum(O[c][j] for c in classes) for j in range(4)]

    def rank(v):
        seen = [((row_m[u] if u in row_m else F.lit(0)) + (col_m[u] if u in range(4) else F.lit(0)) > 0).cast("int")
                for u in sorted({*classes, *range(4)}) if u < v]
        return sum(seen, F.lit(0))

    cand = cand.select("*", *[rank(v).alias(f"i{v}") for v in sorted({*classes, *range(4)})])
    gap = {(c, j): (F.col(f"i{c}") - F.col(f"i{j}")) * (F.col(f"i{c}") - F.col(f"i{j}")) for c in classes for j in range(4)}
    num = sum(gap[c, j] * O[c][j] for c in classes for j in range(4))
    den = sum(gap[c, j] * row_m[c] * col_m[j] for c in classes for j in range(4)) / N
    scored = cand.select(
        (F.lit(lo) + F.col("k1") * step).alias("t1"), (F.lit(lo) + F.col("k2") * step).alias("t2"),
        (F.lit(lo) + F.col("k3") * step).alias("t3"), "k1", "k2", "k3",
        (F.lit(1.0) - F.try_divide(num.cast("double"), den)).alias("qwk"))
    best = scored.agg(F.max_by(F.struct("t1", "t2", "t3", "qwk"),
                               F.struct(F.coalesce("qwk", F.lit(-2.0)), -F.col("k1"), -F.col("k2"), -F.col("k3"))).alias("b"))
    return best.select("b.t1", "b.t2", "b.t3", "b.qwk")
