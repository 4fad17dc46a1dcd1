"""From a model table to final classes: two voting ensembles trained with
stratified folds, each turned into classes with thresholds tuned on its
out-of-fold scores, then a per-id majority vote (smallest class on ties).
All steps keep ``id`` as a column; the result is (id, sii)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.operators.metrics import majority_vote
from pulsegrid.plans.modelling import evaluate_oof, train_ensembles, voting_ensembles


def score_cohort(train: DataFrame, test: DataFrame, label: str, features: Sequence[str],
                 ensembles: Sequence[dict] | None = None, step: float = 0.1, nominal: Sequence[str] = ()) -> tuple[DataFrame, list[DataFrame]]:
    """Returns (final[id, sii], summaries) where each summary row holds the
    ensemble's mean fold QWK, tuned thresholds and tuned QWK. All ensembles
    train in the same passes."""
    ensembles = voting_ensembles() if ensembles is None else ensembles
    train = train.where(F.col(label).isNotNull())
    scores = train_ensembles(train, test, label, features, ensembles, nominal).checkpoint(eager=True)
    votes, summaries = [], []
    for i in range(len(ensembles)):
        own = scores.where(F.col("ensemble") == i)
        oof = own.where("side = 'validation'").select("id", "fold", F.col("y").cast("int").alias("y"), "score")
        test_scores = own.where("side = 'test'").groupBy("id").agg(F.avg("score").alias("score"))
        _, summary, classes = evaluate_oof(oof, test_scores, step=step)
        summaries.append(summary)
        votes.append(classes)
    return vote_submissions(votes).select("id", "sii"), summaries


def vote_submissions(submissions: Sequence[DataFrame], label: str = "sii", key: str = "id") -> DataFrame:
    """Submissions (key, label) joined by key and voted on: key, one column
    per submission, label. A row that a submission lacks has no vote there;
    rows without a key are dropped, as they match nothing."""
    named = [s.where(F.col(key).isNotNull()).select(key, F.col(label).alias(f"{label}_{i}")) for i, s in enumerate(submissions)]
    joined = reduce(lambda a, b: a.join(b, key, "full"), named)
    votes = [f"{label}_{i}" for i in range(len(named))]
    return joined.select(key, *votes, majority_vote(votes).cast("int").alias(label))
