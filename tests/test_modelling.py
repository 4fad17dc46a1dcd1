"""Out-of-fold training and the evaluation that follows it."""

import numpy as np
from pyspark.sql import functions as F

from core_paths import SF

from pulsegrid.catalog import QUERIES
from pulsegrid.operators.metrics import half_even_class, qwk
from pulsegrid.plans import bindings
from pulsegrid.plans.modelling import ensemble_members, evaluate_oof, feature_columns, fold_medians, train_oof, voting_ensembles


def _table(spark, n=240, seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        y = int(rng.integers(0, 4))
        a = y + rng.normal(0, 0.5)
        b = None if i % 7 == 0 else float(rng.normal())
        rows.append((i, y, float(a), b))
    return spark.createDataFrame(rows, "id long, y int, a double, b double")


def test_oof_and_evaluation(spark):
    train = _table(spark)
    test = _table(spark, 40, seed=9).drop("y")
    feats = feature_columns(train, ["id", "y"])
    assert feats == ["a", "b"]
    members = {k: v for k, v in ensemble_members(max_iter=3, max_depth=3).items() if k in ("gbt_a", "rf")}
    oof, tp, own = train_oof(train, test, "y", feats, members, train_side=True)
    # a row trains in every fold but its own
    assert own.count() == 240 * 4 and own.join(oof, ["id", "fold"]).count() == 0
    assert qwk(own.withColumn("p", half_even_class(F.col("score"))), by=["fold"]).count() == 5
    assert oof.count() == 240 and tp.count() == 40
    assert oof.select("fold").distinct().count() == 5
    assert oof.where(F.col("score").isNull()).count() == 0
    per_fold, summary, sub = evaluate_oof(oof, tp)
    s = summary.collect()[0]
    assert s["t1"] < s["t2"] < s["t3"]
    assert s["tuned_qwk"] >= max(r["qwk"] for r in per_fold.collect()) - 0.5
    assert s["tuned_qwk"] > 0.5  # the feature carries the class
    assert set(r["sii"] for r in sub.collect()) <= {0, 1, 2, 3}


def test_score_cohort_majority(spark):
    from pulsegrid.plans.scoring import score_cohort
    train = _table(spark, 200, seed=4)
    test = _table(spark, 30, seed=5).drop("y")
    small = ensemble_members(max_iter=2, max_depth=2)
    final, summaries = score_cohort(train, test, "y", ["a", "b"],
                                    ensembles=[{"gbt_a": small["gbt_a"]}, {"rf": small["rf"]}], step=0.5)
    rows = final.collect()
    assert len(rows) == 30 and all(r["sii"] in (0, 1, 2, 3) for r in rows)
    assert len(summaries) == 2 and summaries[0].collect()[0]["tuned_qwk"] is not None


def test_voting_ensembles_have_the_stated_parameters():
    tuned, plain = voting_ensembles()
    assert len(tuned) == 3 and len(plain) == 5
    assert tuned["leafwise"].rounds == 300 and plain["symmetric"].rounds == 1000
    assert plain["forest"].rounds == 100 and plain["forest"].bagged and plain["stagewise"].depth == 3
    assert (tuned["leafwise"].l1, tuned["levelwise"].l2, tuned["symmetric"].nominal) == (10, 5, True)


def test_fold_medians_equal_plain_ones(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(i % 3), float(rng.normal()) if i % 4 else None, float(i % 7)) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, fold int, a double, b double")
    got = {(r["fold"], r["column"]): r["median"] for r in fold_medians(df, ["a", "b"], 3).collect()}
    for k in range(3):
        for j, c in ((2, "a"), (3, "b")):
            assert got[k, c] == np.median([r[j] for r in rows if r[1] != k and r[j] is not None])


def test_oof_predictions_trains_the_whole_job(spark):
    rows = QUERIES["oof_predictions"](spark, SF).toPandas()
    people = bindings.participants(spark, SF).count()
    assert len(rows) == 2 * people == 2 * rows["id"].nunique() and sorted(rows["ensemble"].unique()) == [0, 1]
    scored = rows[rows["y"].notna()]
    assert 0 < len(scored) < len(rows) and set(scored["fold"]) == set(range(5)) and rows["score"].notna().all()
    assert scored["score"].between(-1, 4).all() and scored.groupby("ensemble")["score"].nunique().min() > 20
