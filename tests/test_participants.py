"""Ordinal target, health features, encoding (hand cases of FIXTURES.md)."""

from pyspark.sql import functions as F

from pulsegrid.operators.encode import encode_per_table, encode_shared
from pulsegrid.plans.participants import FGC_COLUMNS, HEALTH_INPUTS, ITEM_COLUMNS, add_target, health_features


def _target_rows(spark, cases):
    rows = []
    for i, (total, n_missing) in enumerate(cases):
        items = [None] * n_missing + [1.0] * (20 - n_missing)
        rows.append((i, None if total is None else float(total), *items))
    schema = "id int, pciat_pciat_total double, " + ", ".join(f"{c} double" for c in ITEM_COLUMNS)
    return spark.createDataFrame(rows, schema)


def test_recalculated_class(spark):
    cases = [(30, 0), (30, 1), (31, 0), (49, 0), (45, 1), (50, 0), (79, 0), (80, 5), (None, 0)]
    expected = [0, None, 1, 1, None, 2, 2, 3, None]
    out = add_target(_target_rows(spark, cases)).orderBy("id").collect()
    assert [r["recalc_sii"] for r in out] == expected
    assert out[0]["sii"] == "0 (None)" and out[1]["sii"] is None
    assert out[0]["complete_resp_total"] == 30 and out[1]["complete_resp_total"] is None


def _health_frame(spark, rows):
    cols = sorted(set(HEALTH_INPUTS.values()) | set(FGC_COLUMNS))
    full = [{c: r.get(c) for c in cols} for r in rows]
    return spark.createDataFrame([tuple([i] + [f[c] for c in cols]) for i, f in enumerate(full)],
                                 "id int, " + ", ".join(f"{c} double" for c in cols))


def test_health_null_semantics(spark):
    rows = [
        {"paq_a_paq_a_total": 2.0, "paq_c_paq_c_total": None, "physical_height": 1.0, "physical_weight": 2.0,
         "fitness_endurance_max_stage": 5.0, "fitness_endurance_time_mins": 7.0, "fitness_endurance_time_sec": 33.0},
        {"fgc_fgc_cu": 3.0, "fgc_fgc_cu_zone": 0.0, "physical_height": 3.0, "physical_weight": 2.0},
    ]
    out = health_features(_health_frame(spark, rows)).orderBy("id").collect()
    assert out[0]["cumulative_paq"] is None
    assert out[0]["fitness_endurance_score"] == 458
    assert out[0]["fgc_percentage"] == 0.0
    assert out[1]["fgc_percentage"] == 0.5
    assert out[0]["height_norm"] == -1.0 and out[1]["height_norm"] == 1.0
    assert out[0]["weight_norm"] == 0.0  # constant column: scale 1
    assert out[0]["missing_health_data"] == 1 and out[1]["missing_health_data"] == 1


def test_encoder_first_appearance(spark):
    df = spark.createDataFrame([(1, "Winter"), (2, None), (3, "Fall"), (4, "Fall"), (5, "Summer")], "id int, s string")
    out = [r["s"] for r in encode_per_table(df, ["s"]).orderBy("id").collect()]
    assert out == [1, 0, 3, 3, 4]


def test_encoder_shared_unseen(spark):
    train = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    test = spark.createDataFrame([(1, "b"), (2, "zzz"), (3, None)], "id int, s string")
    _, te = encode_shared(train, test, ["s"])
    assert [r["s"] for r in te.orderBy("id").collect()] == [2, 0, 0]


def test_required_columns(spark):
    df = spark.range(3).withColumn("physical_height", F.lit(1.0))
    try:
        health_features(df)
    except ValueError as e:
        assert "physical_weight" in str(e)
    else:
        raise AssertionError("expected ValueError")


def test_drift_and_dictionary(spark):
    from pulsegrid.operators.schema import align_to, column_drift, dictionary_lookup, drift_report
    a = spark.createDataFrame([(1, 2.0, 3.0, 1)], "id int, x double, pciat_total double, recalc_sii int")
    b = spark.createDataFrame([(1, 2.0, "s")], "id int, x double, season string")
    only_a, only_b = column_drift(a, b)
    assert only_a == {"pciat_total", "recalc_sii"} and only_b == {"season"}
    assert [tuple(r) for r in drift_report(spark, a, b).collect()] == [
        ("left", "pciat_total"), ("left", "recalc_sii"), ("right", "season")]
    assert align_to(a, b, keep=["recalc_sii"]).columns == ["id", "x", "recalc_sii"]
    d = spark.createDataFrame([("pciat_total", "total score"), ("x", "a measure")], "field string, description string")
    assert [r["field"] for r in dictionary_lookup(d, only_a).collect()] == ["pciat_total"]
