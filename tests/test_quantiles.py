"""Exact quantiles and equal-frequency buckets."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsegrid.operators.quantiles import exact_quantiles, order_key, qcut_bucket
from pulsegrid.operators.ranking import key_hash, rank_by_key, rank_within, stratified_folds

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 1.0]


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    rows = []
    for g in range(6):
        n = [1, 2, 5, 50, 500, 2000][g]
        vals = rng.integers(0, 30, n).astype(float) if g % 2 else rng.normal(size=n)
        rows += [(g, float(v)) for v in vals]
    rows += [(9, None)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(7)
    got = exact_quantiles(df, ["g"], "v", PROBS, count_name="n").toPandas().set_index("g")
    pdf = pd.DataFrame(rows, columns=["g", "v"]).dropna()
    for g, grp in pdf.groupby("g"):
        for i, p in enumerate(PROBS):
            assert abs(got.loc[g, f"q_{i}"] - grp["v"].quantile(p)) < 1e-12
        assert got.loc[g, "n"] == len(grp)
    assert 9 not in got.index


def test_global_quantile(spark):
    df = spark.createDataFrame([(float(x),) for x in [5, 1, 3, 3, 9]], "v double")
    r = exact_quantiles(df, [], "v", [0.5, 0.25]).collect()[0]
    assert r["q_0"] == 3.0 and r["q_1"] == 3.0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=3, max_size=60))
def test_qcut_bucket_counts_sum_and_match_pandas(spark, values):
    pdf = pd.Series([float(v) for v in values])
    edges = [float(pdf.quantile(i / 4)) for i in range(5)]
    df = spark.createDataFrame([(v,) for v in pdf], "x double")
    got = [r["b"] for r in df.select(qcut_bucket(F.col("x"), [F.lit(e) for e in edges]).alias("b")).collect()]
    assert len(got) == len(values)
    cats = pd.qcut(pdf, 4, duplicates="drop", labels=False) + 1
    assert [None if pd.isna(c) else int(c) for c in cats] == got


def test_rank_within_and_folds(spark):
    rows = [(i, i % 3 if i % 10 else 0) for i in range(503)]
    df = spark.createDataFrame(rows, "id long, y int").repartition(5)
    r = rank_within(df, ["y"], ["id"], "r").toPandas()
    for y, g in r.groupby("y"):
        assert sorted(g["r"]) == list(range(len(g)))
        assert list(g.sort_values("id")["r"]) == list(range(len(g)))
    f = stratified_folds(df, "y", "id", 5, 42).groupBy("y", "fold").count().toPandas()
    for y, g in f.groupby("y"):
        assert g["count"].max() - g["count"].min() <= 1


SETTINGS = [{}, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}, {"spark.sql.adaptive.enabled": "false"},
            {"spark.sql.exchange.reuse": "false"}]


def _under(spark, settings, run):
    held = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        return run()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("settings", SETTINGS)
def test_ranks_lose_no_row_of_a_wide_table(spark, settings):
    orders = spark.read.parquet("/root/testdata/sf0.1/orders.parquet")

    def run():
        r = rank_within(orders.withColumn("y", F.col("o_orderkey") % 3), ["y"], ["o_orderkey"], "r")
        one = r.agg(F.count("*").alias("n"), F.countDistinct("y", "r").alias("d"), F.max("r").alias("m"), F.countDistinct("o_orderkey").alias("k")).first()
        f = stratified_folds(orders.withColumn("y", F.col("o_orderkey") % 3), "y", "o_orderkey")
        return one, f.groupBy("y").agg(F.count("*").alias("n"), F.countDistinct("o_orderkey").alias("k")).agg(F.sum("n"), F.sum("k")).first()

    one, folds = _under(spark, settings, run)
    n = orders.count()
    assert one["n"] == one["d"] == one["k"] == n and tuple(folds) == (n, n)


@pytest.mark.parametrize("settings", SETTINGS)
def test_quantiles_under_any_plan(spark, settings):
    prices = spark.read.parquet("/root/testdata/sf0.1/orders.parquet").selectExpr("o_orderpriority g", "o_totalprice - 150000 v")
    got = _under(spark, settings, lambda: exact_quantiles(prices, ["g"], "v", PROBS).toPandas().set_index("g"))
    for g, part in prices.toPandas().groupby("g"):
        assert np.allclose(got.loc[g], part["v"].astype(float).quantile(PROBS), rtol=1e-12, atol=0)


def test_ranks_with_null_keys_ties_and_text_order(spark):
    rows = [(None, None), (None, "b"), ("x", "a"), ("x", None), ("x", "c"), ("x", "b")]
    got = rank_within(spark.createDataFrame(rows, "g string, o string"), ["g"], ["o"], "r").collect()
    assert sorted((r["g"] or "", r["o"] or "", r["r"]) for r in got) == [("", "", 0), ("", "b", 1), ("x", "", 0), ("x", "a", 1), ("x", "b", 2), ("x", "c", 3)]


def test_quantiles_of_odd_values(spark):
    rows = [(float("inf"),), (float("-inf"),), (0.0,), (-0.0,), (5e-324,), (-1e308,), (1e308,), (None,)]
    df = spark.createDataFrame(rows, "v double")
    r = exact_quantiles(df, [], "v", [0.0, 0.5, 1.0], count_name="n").first()
    assert (r["q_0"], r["q_1"], r["q_2"], r["n"]) == (float("-inf"), 0.0, float("inf"), 7)
    assert exact_quantiles(df.limit(0), [], "v", [0.5]).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.floats(allow_nan=False) | st.floats(1.0, 1.0 + 1e-12) | st.integers(-64, 64).map(lambda e: float(np.nextafter(2.0 ** e, 0))), min_size=2, max_size=40))
def test_order_key_never_falls(spark, values):
    values = sorted(float(v) for v in values)
    keys = [r["k"] for r in spark.createDataFrame([(v,) for v in values], "v double").coalesce(1).select("v", order_key(F.col("v")).alias("k")).collect()]
    assert keys == sorted(keys)


def test_cells_of_narrow_and_skewed_columns_stay_small(spark):
    # 100,000 values in [1, 1.001], one group with three quarters of the rows, one value with 50,000 copies
    df = spark.range(100_000).select(F.when(F.col("id") % 4 > 0, "hot").otherwise("rest").alias("g"), (1 + F.col("id") / 1e8).alias("v"))
    df = df.union(spark.range(50_000).select(F.lit("hot"), F.lit(1.0005)))
    got = exact_quantiles(df, ["g"], "v", PROBS, cell_shifts=(44, 40, 34)).toPandas().set_index("g")
    for g, part in df.toPandas().groupby("g"):
        assert np.allclose(got.loc[g], part["v"].quantile(PROBS), rtol=1e-15, atol=0)
    sizes = df.distinct().groupBy("g", F.shiftright(order_key(F.col("v")), 34)).count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 400 and sizes[1] > 200
    # few bits left open, deep rounds: the same quantiles
    for shifts in ((60, 50, 40, 30, 20, 10, 0), (52,)):
        again = exact_quantiles(df, ["g"], "v", PROBS, cell_shifts=shifts).toPandas().set_index("g")
        assert (again.sort_index() == got.sort_index()).all(None)


def test_count_tree_bounds_every_block(spark):
    # 10**6 rows, 90 % of them in one class: blocks of at most 1,000 rows, and the folds of a plain sort
    df = spark.range(1_000_000).select("id", F.when(F.col("id") % 10 > 0, 0).otherwise(1).alias("y"))
    ranked = rank_by_key(df, ["y"], key_hash("id", 42), ["id"], "r", bound=1_000)
    got = ranked.groupBy("y").agg(F.count("*").alias("n"), F.countDistinct("r").alias("d"), F.max("r").alias("m")).collect()
    assert sorted((r["y"], r["n"], r["d"], r["m"]) for r in got) == [(0, 900_000, 900_000, 899_999), (1, 100_000, 100_000, 99_999)]
    sizes = df.groupBy("y", F.shiftright(key_hash("id", 42), 36)).count().agg(F.max("count")).first()[0]
    assert sizes <= 1_000
    after = ranked.where("y = 1").withColumn("h", key_hash("id", 42)).toPandas().sort_values(["h", "id"])
    assert (after["r"].to_numpy() == np.arange(100_000)).all()
    folds = stratified_folds(df, "y", "id", bound=1_000).groupBy("y", "fold").count().collect()
    assert {(r["y"], r["count"]) for r in folds} == {(0, 180_000), (1, 20_000)}


@pytest.mark.parametrize("bound", [1, 7, 10_000])
def test_count_tree_with_ties_and_null_keys(spark, bound):
    rng = np.random.default_rng(0)
    rows = [(None if i % 5 == 0 else i % 3, int(rng.integers(0, 1 << 16)) if i % 4 else 77, i) for i in range(400)]
    df = spark.createDataFrame(rows, "g int, k long, id long").repartition(3)
    got = rank_by_key(df, ["g"], F.col("k"), ["id"], "r", bits=16, levels=3, bound=bound).collect()
    for g in (None, 0, 1, 2):
        want = [i for _, i in sorted((k, i) for h, k, i in rows if h == g)]
        assert [r["id"] for r in sorted((r for r in got if r["g"] == g), key=lambda r: r["r"])] == want
        assert sorted(r["r"] for r in got if r["g"] == g) == list(range(len(want)))
