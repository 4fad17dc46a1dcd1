"""Ordinal regression with stratified folds.

Folds are a column, predictions keep the ``id`` (no positional alignment),
all members of all ensembles train in all folds in shared passes over a table
that is binned once (``plans.boosting``), the bagged test prediction is an
``avg`` per id, and the tuned thresholds / QWK are aggregations
(``operators.metrics``).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.operators.fitted import fit_row
from pulsegrid.operators.metrics import half_even_class, qwk, threshold_grid, threshold_round
from pulsegrid.operators.quantiles import exact_quantiles
from pulsegrid.operators.ranking import stratified_folds
from pulsegrid.plans.boosting import Learner, Member, bin_values, binned_blocks, ensemble_scores, train_learners
from pulsegrid.session import ensure_checkpoint_dir

SEED = 42
N_SPLITS = 5


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if f.name not in skip and isinstance(f.dataType, (T.NumericType, T.BooleanType))]


def fold_medians(folded: DataFrame, columns: Sequence[str], n_splits: int = N_SPLITS) -> DataFrame:
    """fold, column, median: the exact median of every column over the
    training rows of every fold (the rows of the other folds), in one stacked
    quantile pass."""
    others = F.array_remove(F.sequence(F.lit(0), F.lit(n_splits - 1)), F.col("fold").cast("int"))
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]))
    stacked = folded.select("fold", cells.alias("s")).select(F.explode(others).alias("fold"), "s.column", "s.value")
    return exact_quantiles(stacked, ["fold", "column"], "value", [0.5], names=["median"])


def ensemble_members(max_iter: int = 20, max_depth: int = 4, seed: int = SEED) -> dict[str, Member]:
    """A small ensemble: two boosted members and a forest."""
    return {
        "gbt_a": Member(max_iter, 0.05, max_depth, rows=0.8, columns=0.8, seed=seed),
        "gbt_b": Member(max_iter, 0.1, max_depth - 1, rows=0.75, columns=0.5, leaf_rows=5, seed=seed),
        "rf": Member(max(5, max_iter), depth=max_depth + 2, bagged=True, columns=1 / 3, seed=seed),
    }


def voting_ensembles(seed: int = SEED) -> list[dict[str, Member]]:
    """The two voting ensembles of the source: three tuned boosted members
    (missing values split on the better side, one member takes the nominal
    columns as such), and five with the defaults of their libraries on
    features imputed with medians."""
    # The source's parameters, and its libraries' defaults where it sets none.
    tuned = {
        "leafwise": Member(300, 0.046, 12, rows=0.784, rows_every=4, columns=0.893, leaf_rows=13, leaves=478, l1=10, l2=0.01, seed=seed),
        "levelwise": Member(200, 0.05, 6, rows=0.8, columns=0.8, l1=1, l2=5, seed=seed),
        "symmetric": Member(200, 0.05, 6, l2=10, symmetric=True, nominal=True, seed=seed),
    }
    plain = {
        "leafwise": Member(100, 0.1, 31, leaf_rows=20, leaves=31, impute=True, seed=seed),
        "levelwise": Member(100, 0.3, 6, l2=1, impute=True, seed=seed),
        "symmetric": Member(1000, 0.03, 6, l2=3, symmetric=True, impute=True, seed=seed),
        "forest": Member(100, depth=30, bagged=True, impute=True, seed=seed),
        "stagewise": Member(100, 0.1, 3, impute=True, seed=seed),
    }
    return [tuned, plain]


def train_ensembles(train: DataFrame, test: DataFrame | None, label: str, features: Sequence[str], ensembles: Sequence[dict[str, Member]],
                    nominal: Sequence[str] = (), n_splits: int = N_SPLITS, seed: int = SEED, train_side: bool = False, block_rows: int | None = None) -> DataFrame:
    """Scores of every ensemble in every fold (see ``ensemble_scores``):
    validation rows by the fold that left them out, test rows by every fold.

    Medians are fitted on a fold's training part only; bin edges, which see
    no label, on all rows of ``train``."""
    ensure_checkpoint_dir(train.sparkSession)
    features = list(features)
    folded = stratified_folds(train, label, "id", n_splits, seed).select("id", "fold", label, *features).checkpoint(eager=True)
    rows = folded
    if test is not None:
        rows = folded.unionByName(test.select("id", F.lit(None).cast("int").alias("fold"), F.lit(None).cast("double").alias(label), *features)).checkpoint(eager=True)
    blocks, edges = binned_blocks(rows, label, features, nominal, block_rows)
    base = {r["fold"]: (r["s"], r["n"]) for r in folded.groupBy("fold").agg(F.sum(F.col(label).cast("double")).alias("s"), F.count(label).alias("n")).collect()}
    fill: dict[int, np.ndarray] = {}
    if any(m.impute for e in ensembles for m in e.values()):
        found = {(r["fold"], r["column"]): r["median"] for r in fold_medians(folded, features, n_splits).collect()}  # folds x features rows
        for k in range(n_splits):
            medians = [np.array([np.nan if found.get((k, f)) is None else found[k, f]], float) for f in features]
            fill[k] = np.array([bin_values(m, edges[f], f in set(nominal))[0] for m, f in zip(medians, features, strict=True)], np.uint8)
    learners = []
    for e, members in enumerate(ensembles):
        for member in members.values():
            for k in range(n_splits):
                rest = [v for f, v in base.items() if f != k]
                mean = sum(s or 0.0 for s, _ in rest) / max(1, sum(n for _, n in rest))
                learners.append(Learner(len(learners), member, k, tuple(f in set(nominal) for f in features), fill[k] if member.impute else None, e, mean))
    trees = train_learners(blocks, learners)
    return ensemble_scores(blocks, learners, trees, train.schema["id"].dataType.simpleString(), train_side)


def train_oof(train: DataFrame, test: DataFrame | None, label: str, features: Sequence[str],
              members: dict[str, Member] | None = None, n_splits: int = N_SPLITS, seed: int = SEED,
              train_side: bool = False, nominal: Sequence[str] = (), block_rows: int | None = None):
    """Stratified k-fold: returns (oof[id, fold, y, score], test[id, score] or None);
    with ``train_side`` also the scores of each fold's own training rows, in
    the columns of oof, for the train-side kappa per fold. The test
    prediction is the mean over folds (bagging)."""
    scores = train_ensembles(train, test, label, features, [members or ensemble_members(seed=seed)], nominal, n_splits, seed, train_side, block_rows)
    scores = scores.checkpoint(eager=True)  # trees are not applied again for every use
    typed = ["id", "fold", F.col("y").cast("int").alias("y"), "score"]
    oof = scores.where("side = 'validation'").select(*typed)
    tp = scores.where("side = 'test'").groupBy("id").agg(F.avg("score").alias("score")) if test is not None else None
    if train_side:
        return oof, tp, scores.where("side = 'train'").select(*typed)
    return oof, tp


def evaluate_oof(oof: DataFrame, test_scores: DataFrame | None = None, step: float = 0.1):
    """The evaluation after the folds: per-fold QWK of half-even rounded
    scores, its mean, grid-tuned thresholds with the tuned QWK on the same
    rows, and (if given) the tuned classes of the bagged test scores.

    Returns (per_fold[fold, qwk, n], summary[mean_qwk, t1, t2, t3, tuned_qwk], test[id, sii] or None)."""
    rounded = oof.withColumn("p", half_even_class(F.col("score")))
    per_fold = qwk(rounded, "y", "p", by=["fold"])
    best = fit_row(threshold_grid(oof, "y", "score", step=step))
    t = [F.lit(best["t1"]), F.lit(best["t2"]), F.lit(best["t3"])]
    tuned = oof.withColumn("p", threshold_round(F.col("score"), t))
    tuned_q = fit_row(qwk(tuned, "y", "p"))["qwk"]
    summary = per_fold.agg(F.avg("qwk").alias("mean_qwk")).select(
        "mean_qwk", F.lit(best["t1"]).alias("t1"), F.lit(best["t2"]).alias("t2"), F.lit(best["t3"]).alias("t3"),
        F.lit(tuned_q).cast("double").alias("tuned_qwk"))
    test = None
    if test_scores is not None:
        test = test_scores.select("id", threshold_round(F.col("score"), t).alias("sii"))
    return per_fold, summary, test
