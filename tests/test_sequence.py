"""Chunked ordered windows and runs equal whole-key windows."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from pulsegrid.operators.sequence import longest_run, ordered_window


def _frame(spark, n_hot=400, n_small=30, seed=7):
    rnd = random.Random(seed)
    rows = []
    step = 0
    for i in range(n_hot):  # one hot key with sparse, irregular steps
        step += rnd.choice([1, 1, 2, 5, 40, 300])
        rows.append(("hot", step, rnd.random() * 10, rnd.choice([0, 0, 0, 1])))
    for k in range(5):
        for i in range(n_small):
            rows.append((f"k{k}", i * 3, rnd.random(), rnd.choice([0, 1])))
    return spark.createDataFrame(rows, "id string, step long, v double, flag int")


def _cols(w):
    r = w.rowsBetween(-11, 0)
    return {"d": F.col("v") - F.lag("v", 1).over(w),
            "roll": F.when(F.count("v").over(r) == 12, F.avg("v").over(r))}


def test_ordered_window_matches_whole_key(spark):
    df = _frame(spark)
    got = ordered_window(df, "id", "step", _cols, halo=11, chunk_rows=16).toPandas()
    w = Window.partitionBy("id").orderBy("step")
    exp = df.select("*", *[e.alias(n) for n, e in _cols(w).items()],
                    (F.row_number().over(w) - 1).alias("pos")).toPandas()
    m = got.merge(exp, on=["id", "step"], suffixes=("_g", "_e"))
    assert len(m) == len(exp) == len(got)
    for c in ["d", "roll"]:
        a, b = m[f"{c}_g"], m[f"{c}_e"]
        assert ((a.isna() & b.isna()) | ((a - b).abs() < 1e-12)).all(), c
    assert (m["pos_g"] == m["pos_e"]).all()


def test_rolling_needs_twelve_rows(spark):
    for n, expected_values in [(11, 0), (12, 1)]:
        df = spark.createDataFrame([("a", i, float(i)) for i in range(n)], "id string, step long, v double")
        out = ordered_window(df, "id", "step", _cols, halo=11, chunk_rows=4).toPandas()
        assert out["roll"].notna().sum() == expected_values


def longest_zero_run(flags):
    """Length of the longest stretch of zeros, by walking over the flags."""
    best = here = 0
    for flag in flags:
        here = here + 1 if flag == 0 else 0
        best = max(best, here)
    return best


def test_longest_run_hand_case(spark):
    df = spark.createDataFrame([("a", i, f) for i, f in enumerate([0, 0, 1, 0, 0, 0, 1])], "id string, step long, flag int")
    r = longest_run(df, "id", "step", F.col("flag") == 0, "run", chunk_rows=2).collect()
    assert r[0]["run"] == 3


def test_longest_run_matches_pandas(spark):
    df = _frame(spark)
    got = {r["id"]: r["run"] for r in longest_run(df, "id", "step", F.col("flag") == 0, "run", chunk_rows=8).collect()}
    flags = {}
    for r in df.orderBy("id", "step").collect():
        flags.setdefault(r["id"], []).append(r["flag"])
    assert got == {k: longest_zero_run(f) for k, f in flags.items()}


def test_longest_run_null_breaks(spark):
    df = spark.createDataFrame([("a", 0, 0), ("a", 1, None), ("a", 2, 0), ("a", 3, 0)], "id string, step long, flag int")
    assert longest_run(df, "id", "step", F.col("flag") == 0, "run", chunk_rows=1).collect()[0]["run"] == 2


def test_row_windows_are_keyed_by_chunk(spark):
    """No window over series rows is partitioned by the subject alone."""
    import re
    df = _frame(spark)
    plan = ordered_window(df, "id", "step", _cols, halo=11, chunk_rows=16)._jdf.queryExecution().executedPlan().toString()
    specs = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[[^\]]*\]", plan)
    row_windows = [s for s in specs if "_chunk" in s]
    assert row_windows, plan
    # the only id-only window runs over the per-chunk table (columns _chunk/_cnt)
    assert all("_chunk" in s or re.fullmatch(r"id#\d+", s.strip()) for s in specs)


def test_attach_by_chunk_equals_key_join(spark):
    from pulsegrid.operators.sequence import attach_by_chunk
    df = _frame(spark)
    table = df.groupBy("id").agg(F.avg("v").alias("m"), F.count(F.lit(1)).alias("n"))
    got = attach_by_chunk(df, "id", "step", table, chunk_rows=16)
    exp = df.join(table, "id", "left")
    assert got.count() == exp.count()
    assert got.select(sorted(exp.columns)).exceptAll(exp.select(sorted(exp.columns))).count() == 0


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(1, 30), st.integers(0, 2)), min_size=1, max_size=60),
       st.sampled_from([1, 2, 3, 7, 50]))
def test_chunked_equals_whole_key_property(spark, events, chunk_rows):
    rows, steps = [], {"a": 0, "b": 0}
    for i, (k, gap, flag) in enumerate(events):
        steps[k] += gap
        rows.append((k, steps[k], float(i % 11), None if flag == 2 else flag))
    df = spark.createDataFrame(rows, "id string, step long, v double, flag int")
    got = ordered_window(df, "id", "step", _cols, halo=11, chunk_rows=chunk_rows).toPandas()
    w = Window.partitionBy("id").orderBy("step")
    exp = df.select("*", *[e.alias(n) for n, e in _cols(w).items()], (F.row_number().over(w) - 1).alias("pos")).toPandas()
    m = got.merge(exp, on=["id", "step"], suffixes=("_g", "_e"))
    assert len(m) == len(exp) == len(got)
    for c in ["d", "roll"]:
        a, b = m[f"{c}_g"], m[f"{c}_e"]
        assert ((a.isna() & b.isna()) | ((a - b).abs() < 1e-12)).all(), c
    assert (m["pos_g"] == m["pos_e"]).all()
    runs = {r["id"]: r["run"] for r in longest_run(df, "id", "step", F.col("flag") == 0, "run", chunk_rows).collect()}
    flags = {}
    for k, _, _, flag in rows:
        flags.setdefault(k, []).append(flag)
    assert runs == {k: longest_zero_run(f) for k, f in flags.items()}
