"""Metrics, rounding, voting, threshold grid."""

import numpy as np
from pyspark.sql import functions as F

from pulsegrid.operators import metrics as M


def _qwk_numpy(y, p):
    labels = sorted(set(y) | set(p))
    idx = {v: i for i, v in enumerate(labels)}
    k = len(labels)
    O = np.zeros((k, k))
    for a, b in zip(y, p):
        O[idx[a], idx[b]] += 1
    w = np.array([[(i - j) ** 2 for j in range(k)] for i in range(k)], dtype=float)
    E = np.outer(O.sum(1), O.sum(0)) / O.sum()
    return 1 - (w * O).sum() / (w * E).sum()


def test_threshold_round_and_half_even(spark):
    df = spark.createDataFrame([(0.49,), (0.5,), (1.5,), (2.5,), (None,)], "s double")
    assert [r[0] for r in df.select(M.threshold_round(F.col("s"))).collect()] == [0, 1, 2, 3, 3]
    df2 = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "s double")
    assert [r[0] for r in df2.select(M.half_even_class(F.col("s"))).collect()] == [0, 2, 2]


def test_majority_vote(spark):
    df = spark.createDataFrame([(1, 0, 2), (2, 2, 1), (3, 3, 3)], "a int, b int, c int")
    assert [r[0] for r in df.select(M.majority_vote(["a", "b"])).collect()] == [0, 2, 3]
    assert [r[0] for r in df.select(M.majority_vote(["a", "b", "c"])).collect()] == [0, 2, 3]


def test_qwk_matches_direct_computation(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 4, 500)
    p = np.clip(y + rng.integers(-1, 2, 500), 0, 3)
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(y, p)], "y int, p int")
    got = M.qwk(df).collect()[0]["qwk"]
    assert abs(got - _qwk_numpy(list(y), list(p))) < 1e-12
    same = spark.createDataFrame([(int(a), int(a)) for a in y], "y int, p int")
    assert M.qwk(same).collect()[0]["qwk"] == 1.0


def test_qwk_missing_class_uses_label_union(spark):
    y, p = [0, 2, 2, 3], [0, 2, 3, 3]
    df = spark.createDataFrame(list(zip(y, p)), "y int, p int")
    assert abs(M.qwk(df).collect()[0]["qwk"] - _qwk_numpy(y, p)) < 1e-12


def test_threshold_grid_brute_force(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 4, 120)
    s = np.clip(y + rng.normal(0, 0.7, 120), 0, 3.9)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, score double")
    best = M.threshold_grid(df, "y", "score", step=0.5, lo=0.0, hi=4.0).collect()[0]
    K, top = 8, None
    for k1 in range(K + 1):
        for k2 in range(k1 + 1, K + 1):
            for k3 in range(k2 + 1, K + 1):
                p = [sum(v >= k * 0.5 for k in (k1, k2, k3)) for v in s]
                q = _qwk_numpy(list(y), p)
                if top is None or q > top[0] + 1e-12:
                    top = (q, k1, k2, k3)
    assert abs(best["qwk"] - top[0]) < 1e-9
    assert (round(best["t1"] / 0.5), round(best["t2"] / 0.5), round(best["t3"] / 0.5)) == top[1:]


def test_threshold_grid_is_the_kappa_of_rounded_scores(spark):
    """Scores on grid points (17 * 0.1 is above 1.7), class 2 absent, one score missing."""
    rows = [(0, 0.3), (0, 1.7), (1, 1.7), (1, 0.6), (3, 3.1), (3, None), (0, 0.1), (1, 3.0)]
    df = spark.createDataFrame(rows, "y int, score double")
    b = M.threshold_grid(df, "y", "score").collect()[0]
    rounded = df.withColumn("p", M.threshold_round(F.col("score"), (b["t1"], b["t2"], b["t3"])))
    assert abs(M.qwk(rounded).collect()[0]["qwk"] - b["qwk"]) < 1e-12


def test_confusion_and_report(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (3, 3)], "y int, p int")
    c = {(r["y"], r["p"]): r["count"] for r in M.confusion(df).collect()}
    assert len(c) == 16 and c[(0, 1)] == 1 and c[(2, 2)] == 0
    rep = {r["cls"]: r for r in M.class_report(df).collect()}
    assert rep[0]["recall"] == 0.5 and rep[1]["precision"] == 0.5 and rep[2]["precision"] is None
    s = M.regression_summary(df).collect()[0]
    assert s["accuracy"] == 0.75 and s["mae"] == 0.25


def test_labels_outside_the_grid_are_counted(spark):
    from pulsegrid.operators.metrics import class_report, confusion
    df = spark.createDataFrame([(0, 0), (1, 4), (4, 4), (4, 1)], "y int, p int")
    got = {(r["y"], r["p"]): r["count"] for r in confusion(df).collect()}
    assert sum(got.values()) == 4 and got[(4, 4)] == 1 and got[(1, 4)] == 1 and len(got) == 25
    assert {r["cls"]: r["support"] for r in class_report(df).collect()} == {0: 1, 1: 1, 2: 0, 3: 0, 4: 2}
