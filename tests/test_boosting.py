"""Trees grown in shared passes: splits against exhaustive search, subsets of
nominal codes, missing values, and blocks against one block."""

import itertools
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.plans import boosting
from pulsegrid.plans.boosting import MISSING, Learner, Member, Tree, bin_values, binned_blocks, ensemble_scores, train_learners


def block(bins, y, fold=None):
    bins = np.array(bins, np.uint8)
    n = len(bins)
    return {"bins": bins, "y": np.array(y, float), "fold": np.ones(n, int) if fold is None else np.array(fold), "hash": np.arange(n, dtype=np.uint64) * np.uint64(2654435761),
            "score": {0: np.zeros(n)}}


def grow(learner, data):
    while True:
        tree = learner.grow(learner.splits(*learner.sums(data)))
        if tree is not None:
            return tree


def stump(member, data, nominal=(False,)):
    return grow(Learner(0, member, 0, nominal, None), data)


def squares(y, left):
    return sum(((part - part.mean()) ** 2).sum() for part in (y[left], y[~left]) if len(part))


@pytest.mark.parametrize("seed", range(5))
def test_root_split_is_the_best_of_all(seed):
    rng = np.random.default_rng(seed)
    bins = np.where(rng.random((60, 3)) < 0.1, MISSING, rng.integers(0, 6, (60, 3)))
    y = rng.normal(size=60) + bins[:, 1] % 4
    tree = stump(Member(1, 1.0, 1), block(bins, y), (False,) * 3)
    left = (tree.mask[0] >> bins[:, tree.feature[0]]) & 1 == 1
    best = min(squares(y, (bins[:, j] <= cut) | ((bins[:, j] == MISSING) & side)) for j in range(3) for cut in range(6) for side in (False, True))
    assert np.isclose(squares(y, left.astype(bool)), best)
    assert np.allclose(tree.score(bins.astype(np.uint8)), np.where(left, y[left.astype(bool)].mean(), y[~left.astype(bool)].mean()))


@pytest.mark.parametrize("seed", range(5))
def test_a_season_splits_by_its_best_subset(seed):
    rng = np.random.default_rng(seed)
    code = rng.integers(0, 5, 80)
    y = rng.normal(size=5)[code] + rng.normal(0, 0.1, 80)
    data = block(code[:, None], y)
    tree = stump(Member(1, 1.0, 1, nominal=True), data, (True,))
    left = ((tree.mask[0] >> code) & 1).astype(bool)
    best = min(squares(y, np.isin(code, s)) for k in range(1, 5) for s in itertools.combinations(range(5), k))
    assert np.isclose(squares(y, left), best)
    by_order = stump(Member(1, 1.0, 1), data, (True,))  # a member that takes the codes as numbers
    assert squares(y, ((by_order.mask[0] >> code) & 1).astype(bool)) >= best - 1e-9


def test_penalties_leaf_rows_and_leaves():
    rng = np.random.default_rng(0)
    bins = rng.integers(0, 20, (200, 4))
    y = bins[:, 0] + rng.normal(size=200)
    data = block(bins, y)
    tree = stump(Member(1, 0.5, 1, l1=3, l2=2), data, (False,) * 4)
    left = ((tree.mask[0] >> bins[:, tree.feature[0]]) & 1).astype(bool)
    assert np.isclose(tree.value[1], 0.5 * (y[left].sum() - 3) / (left.sum() + 2)) and np.isclose(tree.value[2], 0.5 * (y[~left].sum() - 3) / ((~left).sum() + 2))
    deep = stump(Member(1, 1.0, 8, leaf_rows=15, leaves=6), data, (False,) * 4)
    sizes = np.bincount(deep.leaf_of(data["bins"]))
    assert sum(f < 0 for f in deep.feature) <= 6 and sizes[sizes > 0].min() >= 15
    even = stump(Member(1, 1.0, 3, symmetric=True), data, (False,) * 4)
    levels = {0: [0]}
    for d in range(3):
        levels[d + 1] = [c for n in levels[d] if even.feature[n] >= 0 for c in (even.left[n], even.left[n] + 1)]
        assert len({(even.feature[n], even.mask[n]) for n in levels[d] if even.feature[n] >= 0}) == 1


def test_boosting_fits_and_forests_average():
    rng = np.random.default_rng(1)
    bins = rng.integers(0, 30, (400, 5))
    y = np.sin(bins[:, 0] / 5) + (bins[:, 1] > 10) * (bins[:, 2] > 15)
    data = block(bins, y)
    learner, total = Learner(0, Member(60, 0.2, 4, rows=0.8, columns=0.8, leaf_rows=3), 0, (False,) * 5, None), np.zeros(400)
    for _ in range(60):
        tree = grow(learner, data)
        total += tree.score(data["bins"])
        data["score"] = {0: total}
    assert learner.finished and ((total - y) ** 2).mean() < 0.02 * y.var()
    forest = Learner(0, Member(20, depth=30, bagged=True), 0, (False,) * 5, None)
    trees = [grow(forest, data) for _ in range(20)]
    assert len({tuple(t.feature) for t in trees}) > 10
    assert ((np.mean([t.score(data["bins"]) for t in trees], 0) - y) ** 2).mean() < 0.05 * y.var()


def test_bins_keep_order_and_share_the_rare():
    values = np.array([np.nan, -5.0, 0.0, 0.5, 1.0, 9.0])
    assert bin_values(values, np.array([0.0, 1.0]), False).tolist() == [MISSING, 0, 0, 1, 1, 2]
    assert bin_values(np.array([3.0, 7.0, np.nan, 8.0]), np.array([7.0, 3.0]), True).tolist() == [1, 0, MISSING, MISSING - 1]
    assert Tree().score(np.zeros((3, 2), np.uint8)).tolist() == [0, 0, 0]


def test_many_blocks_equal_one(spark):
    rng = np.random.default_rng(4)
    rows = [(i, None if i % 11 == 0 else int(i % 5), float(i % 4), float(rng.normal() + i % 4), None if i % 6 == 0 else float(rng.normal()), i % 3) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, fold int, y double, a double, b double, season int").repartition(3)
    members = [Member(4, 0.3, 3, rows=0.8, columns=0.7), Member(3, 0.3, 3, symmetric=True, nominal=True), Member(3, depth=5, bagged=True), Member(2, 0.3, 2, impute=True)]

    def learners():
        return [Learner(i, m, k, (False, False, True), np.array([3, 9, 0], np.uint8) if m.impute else None, i // 2 % 2, 1.5) for i, (m, k) in enumerate(itertools.product(members, (0, 3)))]

    found = []
    for size in (1000, 60):
        blocks, _ = binned_blocks(df, "y", ["a", "b", "season"], ["season"], size)
        assert (blocks.count() > 3) == (size == 60)
        who = learners()
        trees = train_learners(blocks, who)
        assert [len(trees[x.number]) for x in who] == [4, 4, 3, 3, 3, 3, 2, 2]
        scores = ensemble_scores(blocks, who, trees, "bigint", True).toPandas()
        found.append(scores.sort_values(["ensemble", "fold", "id"]).reset_index(drop=True))
    assert len(found[0]) == 2 * 2 * 400 and np.allclose(found[0]["score"], found[1]["score"])
    assert (found[0].drop(columns="score") == found[1].drop(columns="score")).all(None)
    assert set(found[0]["side"]) == {"test", "validation", "train"}


def test_no_rows_and_no_labels(spark):
    df = spark.createDataFrame([(1, None, None, 1.0), (2, None, None, None)], "id long, fold int, y double, a double")
    for some in (df, df.limit(0), df.withColumn("a", F.lit(None).cast("double"))):
        blocks, _ = binned_blocks(some, "y", ["a"])
        who = [Learner(0, replace(Member(2), depth=2), 0, (False,), None)]
        scores = ensemble_scores(blocks, who, train_learners(blocks, who), "bigint").collect()
        assert [r["score"] for r in scores] == [0.0] * some.count()


def test_blocks_meet_and_alone_grow_the_same_trees(spark):
    rng = np.random.default_rng(7)
    rows = [(i, None if i % 11 == 0 else int(i % 5), float(i % 4), float(rng.normal() + i % 4), None if i % 6 == 0 else float(rng.normal())) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, fold int, y double, a double, b double").repartition(3)
    members = [Member(3, 0.3, 4, rows=0.8), Member(3, 0.3, 3, symmetric=True), Member(2, depth=12, bagged=True, impute=True)]
    blocks, _ = binned_blocks(df, "y", ["a", "b"], (), 60)
    found = []
    for most in (1, 16):  # 16: several blocks, read by one task a learner; their scores took a pass a level before
        who = [Learner(i, m, 0, (False, False), np.array([3, 9], np.uint8) if m.impute else None, i, 1.5) for i, m in enumerate(members)]
        trees = train_learners(blocks, who, most)
        assert [len(trees[i]) for i in range(3)] == [3, 3, 2]
        assert [x.done for x in who] == ([0, 0, 0] if most > 1 else [3, 3, 2])  # trained in tasks, or in passes of the driver
        found.append([[(t.feature, t.mask, np.round(t.value, 9).tolist()) for t in trees[i]] for i in range(3)])
    assert found[0] == found[1]


def test_a_wide_frontier_is_split_in_parts(monkeypatch):
    rng = np.random.default_rng(9)
    bins = rng.integers(0, 30, (500, 3))
    data = block(bins, rng.normal(size=500))
    seen = []
    plain = Learner.sums
    monkeypatch.setattr(Learner, "sums", lambda self, b, *a: seen.append(plain(self, b, *a)) or seen[-1])
    trees = []
    for nodes in (8, 1 << 20):
        monkeypatch.setattr("pulsegrid.plans.boosting.NODES", nodes)
        seen.clear()
        learner, tree = Learner(0, Member(1, depth=30, bagged=True), 0, (False,) * 3, None), None
        while tree is None:
            tree = learner.step(data)
        trees.append((tree.feature, tree.mask, tree.value))
        assert (max(len(g) for g, _ in seen) <= 8) == (nodes == 8)
    assert trees[0] == trees[1]


def test_tasks_grow_the_trees_of_the_plain_steps(spark):
    """``Trees.java``, over several blocks, against ``Learner.step`` over one table."""
    rng = np.random.default_rng(11)
    rows = [(i, None if i % 9 == 0 else int(i % 5), float(rng.integers(0, 4)), None if i % 3 else float(rng.normal()), float(rng.normal()), 7.0, None if i % 7 == 0 else int(i % 6)) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, fold int, y double, a double, b double, c double, season int")
    blocks, _ = binned_blocks(df, "y", ["a", "b", "c", "season"], ["season"], 150)
    held = [boosting._open(r) for r in sorted(blocks.collect(), key=lambda r: r["block"])]
    assert len(held) > 2
    members = [Member(6, 0.1, 5, rows=0.7, rows_every=2, columns=0.5, leaf_rows=3, leaves=9, l1=0.5, l2=0.1), Member(5, 0.1, 4, l2=2, symmetric=True, nominal=True),
               Member(4, 0.3, 3, nominal=True), Member(4, 0.3, 3, symmetric=True, impute=True), Member(25, depth=30, bagged=True, impute=True, columns=0.5)]
    learners = [Learner(i, m, 2, (False, False, False, True), np.array([4, 9, 0, 1], np.uint8) if m.impute else None, 0, 1.5) for i, m in enumerate(members)]
    grown = train_learners(blocks, learners)
    for x in learners:
        data = {c: np.concatenate([b[c] for b in held]) for c in ("bins", "hash", "fold", "y")}
        data["score"] = {x.number: np.full(len(data["y"]), x.base)}
        one, trees = replace(x), []
        while not one.finished:
            if (tree := one.step(data)) is not None:
                trees.append(tree)
                if not one.member.bagged:
                    data["score"][x.number] += tree.score(one.bins(data))
        assert [(t.feature, t.mask, t.left) for t in grown[x.number]] == [(t.feature, t.mask, t.left) for t in trees] and max(len(t.feature) for t in trees) > 6
        assert all(np.allclose(t.value, u.value, rtol=1e-9, atol=1e-12) for t, u in zip(grown[x.number], trees, strict=True))
    # scores that the tasks add up, against trees applied to the rows
    by_task, by_tree = (ensemble_scores(blocks, learners, t, "bigint", True).toPandas().sort_values("id") for t in (grown, {n: grown[n] for n in grown}))
    assert len(by_task) == 600 and np.allclose(by_task["score"], by_tree["score"]) and (by_task.drop(columns="score").values == by_tree.drop(columns="score").values).all()
    assert len(grown.scores(False).where("number = 4").select("first").distinct().collect()) == 3  # a forest is dealt out


def test_trees_of_one_class_and_of_no_training_rows(spark):
    df = spark.createDataFrame([(i, 0, 1.0, float(i)) for i in range(80)], "id long, fold int, y double, a double")
    blocks, _ = binned_blocks(df, "y", ["a"], (), 30)
    for fold, bagged in itertools.product((0, 1), (False, True)):  # fold 0 holds every row: none trains
        who = [Learner(0, Member(3, depth=4, bagged=bagged), fold, (False,), None, 0, 0.25)]
        trees = train_learners(blocks, who)
        assert [t.feature for t in trees[0]] == [[-1]] * 3 if fold == 0 or bagged else len(trees[0]) == 3
        scores = {r["score"] for r in ensemble_scores(blocks, who, trees, "bigint", True).collect()}
        assert all(np.isclose(s, (0.0 if fold == 0 else 1.0) if bagged else 0.25 + (0 if fold == 0 else 0.75 * (1 - 0.9 ** 3))) for s in scores)
