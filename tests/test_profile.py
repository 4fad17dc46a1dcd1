"""Profiling operators: null-aware splits, triage bands, dense counts, histograms."""


from pulsegrid.functions.nulls import not_equal_null_aware
from pulsegrid.operators import profile as PR


def test_not_equal_keeps_nulls(spark):
    df = spark.createDataFrame([(0,), (5,), (None,)], "c int")
    assert [r[0] for r in df.where(not_equal_null_aware("c", 0)).collect()] == [5, None]


def test_triage_bands(spark):
    rep = spark.createDataFrame([("a", 10.0), ("b", 50.0), ("c", 9.9), ("d", 30.0), ("e", 50.1)],
                                "field string, missing_pct double")
    got = {r["field"]: r["action"] for r in PR.missing_triage(rep).collect()}
    assert got == {"a": None, "b": None, "c": "keep", "d": "impute", "e": "remove"}


def test_dense_counts_zero_rows(spark):
    df = spark.createDataFrame([(1, "A", 5), (2, "A", 6), (3, "B", 5), (4, None, 7)], "id int, cls string, age int")
    out = {(r["cls"], r["age"]): r["count"] for r in PR.dense_counts(df, "cls", ["A", "B", "C"], "age").collect()}
    assert out[("C", 5)] == 0 and out[("B", 6)] == 0 and out[("A", 5)] == 1 and out[("A", 7)] == 0
    assert len(out) == 9


def test_histogram_bins(spark):
    df = spark.createDataFrame([(None if x is None else float(x),) for x in [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, None]], "v double")
    h = PR.histogram(df, "v", 5).orderBy("bin").collect()
    assert [r["count"] for r in h] == [2, 2, 2, 2, 3]
    assert h[0]["lo"] == 0.0 and h[-1]["hi"] == 10.0


def test_quantile_buckets_raise_on_duplicate_edges(spark):
    df = spark.createDataFrame([(1.0,)] * 10 + [(2.0,)], "v double")
    try:
        PR.quantile_buckets(df, "v", 4).collect()
    except Exception as e:  # noqa: BLE001
        assert "unique" in str(e)
    else:
        raise AssertionError("expected duplicate-edge failure")
    out = PR.quantile_buckets(df, "v", 4, duplicates="drop").groupBy("v_bucket").count().collect()
    assert sum(r["count"] for r in out) == 11


def test_correlation_rounding(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (3.0, 5.9), (None, 1.0)], "a double, t double")
    r = PR.correlation_table(df, ["a"], "t").collect()[0]
    assert r["corr_pct"] == round(r["corr"], 2) * 100


def test_building_these_queries_runs_nothing(spark, monkeypatch):
    from core_paths import SF
    from pyspark.sql.classic.dataframe import DataFrame

    from pulsegrid.catalog import QUERIES

    def ran(*_):
        raise AssertionError("an action while the query is built")

    for action in ("collect", "count", "toPandas", "toArrow", "checkpoint"):
        monkeypatch.setattr(DataFrame, action, ran)
    for name in ("health_features", "bucket_report", "score_histogram", "encode_per_table", "missing_report_wide", "model_table"):
        assert QUERIES[name](spark, SF).columns
