"""Series features against the registered SQL run by DuckDB, hand-computed
frames and the invariants of FIXTURES.md F4."""

import math

import duckdb
from core_paths import SF

from pulsegrid.catalog import rounded
from pulsegrid.oracle import all_sql
from pulsegrid.plans import bindings
from pulsegrid.plans import series as S


def same(a, b):
    if a is None or b is None or a != a or b != b:
        return (a is None or a != a) and (b is None or b != b)
    return math.isclose(float(a), float(b), rel_tol=1e-6, abs_tol=2e-6)


def test_series_features_match_sql_for_small_chunks(spark):
    con = duckdb.connect()
    for t in ("events", "customer", "orders"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    out = con.sql(all_sql()["series_features"])
    want = {r[out.columns.index("id")]: dict(zip(out.columns, r, strict=True)) for r in out.fetchall()}
    got = {r["id"]: r.asDict() for r in rounded(S.series_features(bindings.series(spark, SF), chunk_rows=32)).collect()}
    assert got.keys() == want.keys()
    assert set(S.FEATURE_NAMES) <= set(next(iter(got.values())))
    bad = [(c, i, got[i][c], want[i][c]) for i in got for c in S.FEATURE_NAMES if not same(got[i][c], want[i][c])]
    assert not bad, bad[:10]


def test_invariants(spark):
    ser = bindings.series(spark, SF)
    f = S.stat_aliases(S.series_features(ser)).toPandas()
    n_wear = ser.where("non_wear_flag = 0").groupBy("id").count().toPandas().set_index("id")["count"]
    for _, r in f.iterrows():
        assert r.stat_9 == r.stat_12 and r.stat_10 == r.stat_13
        assert abs(r.stat_18 + r.stat_19 + r.stat_20 - 1) < 1e-12
        assert r.stat_31 == 1 and r.stat_32 == 1 and r.stat_33 == n_wear[r.id]
        assert abs(r.stat_41 * 720 / r.stat_33 - (r.stat_19 + r.stat_20)) < 1e-9
        assert abs(r.stat_27 * r.stat_33 - round(r.stat_27 * r.stat_33)) < 1e-9


def test_raw_scope_wear(spark):
    ser = bindings.series(spark, SF)
    raw = {r["id"]: r for r in S.wear_streaks(ser, "raw").collect()}
    flags = {}
    for r in ser.select("id", "non_wear_flag").orderBy("id", "step").collect():
        flags.setdefault(r["id"], []).append(r["non_wear_flag"])
    for k, f in flags.items():
        best = here = 0
        for x in f:
            here = here + 1 if x == 0 else 0
            best = max(best, here)
        assert math.isclose(raw[k]["wear_time_ratio"], f.count(0) / len(f))
        assert raw[k]["wear_consistency"] == len(set(f)) and raw[k]["longest_wear_streak"] == best


def test_hot_subject_split_across_chunks(spark):
    """One subject with most of the rows gives the same 58 features cut into
    many chunks as in one chunk."""
    import random
    rnd = random.Random(11)
    rows = []
    for sid, n in [("hot", 3000)] + [(f"s{k}", 40) for k in range(8)]:
        step = 0
        for _ in range(n):
            step += rnd.choice([1, 1, 1, 3, 50])
            x, z = rnd.uniform(-2, 2), rnd.uniform(-1, 1)
            light = float(rnd.randint(0, 120))
            y = light / 100
            tod = rnd.randrange(0, 86_400) * 1_000_000_000
            day = step // 2000
            rows.append((sid, step, x, y, z, max((x * x + y * y + z * z) ** 0.5 - 1, 0.0),
                         float(rnd.randint(-90, 90)), rnd.choice([0, 0, 0, 0, 1]), light,
                         4200.0 - step / 10 - rnd.randint(0, 6), tod, 1 + day % 7, 1, day - 10))
    ser = spark.createDataFrame(rows, S.SERIES_SCHEMA)
    whole = {r["id"]: r for r in S.series_features(ser, chunk_rows=1 << 40).collect()}
    got = {r["id"]: r for r in S.series_features(ser, chunk_rows=100).collect()}
    assert got.keys() == whole.keys() and len(got) == 9
    bad = [(c, i) for i in got for c in S.FEATURE_NAMES if not same(got[i][c], whole[i][c])]
    assert not bad, bad[:10]


def test_peak_hour_tie_and_empty_weekend(spark):
    """Equal hourly means at hours 3 and 9 -> peak hour 3 (first on ties);
    no weekend rows -> weekend ratio is missing, not an error."""
    ns = 3_600_000_000_000
    rows = []
    for i, (hour, x) in enumerate([(3, 1.0), (9, 1.0), (12, 0.5), (3, 1.0), (9, 1.0)]):
        rows.append(("a", i, x, 0.0, 0.0, 0.0, 0.0, 0, 10.0, 4000.0 - i, hour * ns, 2, 1, 0))
    ser = spark.createDataFrame(rows, S.SERIES_SCHEMA)
    r = S.series_features(ser, chunk_rows=2).collect()[0]
    assert r["peak_activity_hour"] == 3 and r["trough_activity_hour"] == 12
    assert r["weekend_activity_ratio"] is None
    assert r["good_sleep_cycle"] == 1 and r["light_exposure_during_sleep"] == 10.0


def _written(plan):
    """Records that the exchanges below a plan node wrote, reused ones once."""
    name = plan.getClass().getSimpleName()
    if name == "ReusedExchangeExec":
        return 0
    own = plan.metrics().get("shuffleRecordsWritten").get().value() if name == "ShuffleExchangeExec" else 0
    below = [plan.executedPlan()] if name == "AdaptiveSparkPlanExec" else [plan.plan()] if name.endswith("QueryStageExec") else []
    kids = plan.children()
    return own + sum(map(_written, [*below, *(kids.apply(i) for i in range(kids.size()))]))


def test_series_features_deal_the_rows_about_once(spark):
    ser = bindings.series(spark, SF)
    df = S.series_features(ser)
    df.collect()
    wear = ser.where("non_wear_flag = 0").count()
    # the rows once, their counts, and a few rows an id and level; copies per level, metric and halo came to 23 a wear row of 3 million events
    assert _written(df._jdf.queryExecution().executedPlan()) < 4 * wear + 50 * df.count()


def test_id_quantiles_of_small_and_large_ids(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    rows = [(i, None if j == 7 else j, float(v), None if j % 3 else float(j), None) for i, n in ((1, 1), (2, 40), (3, 90), (4, 55))
            for j, v in enumerate(rng.normal(size=n).round(1))]
    df = spark.createDataFrame([(*r, 0.0, 0.0, 0.0, 0.0, 0, 1, 1, 1) for r in rows + [(None, 1, 5.0, 1.0, 1.0)]],
                               "id int, step long, x double, light double, battery_voltage double, y double, z double, enmo double, anglez double, hour int, weekday int, relative_date int, q int")
    got = {r["id"]: r for r in S.id_quantiles(S.by_chunk(df, 32), small_rows=50).collect()}  # ids 3 and 4 take the histogram
    assert sorted(got) == [1, 2, 3, 4]
    for i, r in got.items():
        mag = [abs(x[2]) for x in rows if x[0] == i]
        assert np.allclose([r[f"mag_e{k}"] for k in range(11)] + [r["mag_p95"]], np.quantile(mag, [*S.decile_probs(10), 0.95]))
        assert np.allclose([r["light_p25"], r["light_p75"]], np.quantile([x[3] for x in rows if x[0] == i and x[3] is not None], [0.25, 0.75]))
        assert r["battery_p10"] is None
