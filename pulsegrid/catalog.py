"""Registered queries: each operator of the library run on the driver's
tables through ``plans.bindings`` (whole tables, no sampling).

Every callable takes (spark, sf_dir) and returns a DataFrame whose double
columns are rounded to ``DIGITS`` places (the oracle rounds the same way).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.operators import metrics as M
from pulsegrid.operators import profile as PR
from pulsegrid.operators.encode import encode_per_table, encode_shared
from pulsegrid.operators.ranking import stratified_folds
from pulsegrid.plans import bindings as B
from pulsegrid.plans import series as S
from pulsegrid.plans.model_table import align_train, build_model_table
from pulsegrid.plans.participants import SII_LABELS, add_target, health_features
from pulsegrid.plans.scoring import vote_submissions
from pulsegrid.session import ensure_checkpoint_dir
from pulsegrid.sources.io import read_csv, read_series, read_with_lineage, write_csv, write_parquet

DIGITS = 6
SEASONS_B = ["basic_demos_enroll_season", "physical_season"]
PHYSICAL = ["physical_bmi", "physical_height", "physical_weight", "physical_waist_circumference",
            "physical_diastolic_bp", "physical_heartrate", "physical_systolic_bp"]


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType))
                       else F.col(f.name) for f in df.schema.fields])


def _series(spark, d):
    return B.series(spark, d)


def _participants_t(spark, d):
    return add_target(B.participants(spark, d), items=B.ITEM_COLS, total="pciat_pciat_total", bands=B.BINDING_BANDS)


# ------------------------------------------------------------- series
def q_daypart_activity(spark, d):
    return rounded(S.daypart_activity(_series(spark, d)))


def q_sleep_quality(spark, d):
    return rounded(S.sleep_quality(_series(spark, d)))


def q_intensity_ratios(spark, d):
    return rounded(S.intensity_ratios(_series(spark, d)))


def q_circadian(spark, d):
    return rounded(S.circadian(_series(spark, d)))


def q_movement_entropy(spark, d):
    return rounded(S.movement_entropy(_series(spark, d)))


def q_ordered_movement(spark, d):
    return rounded(S.ordered_movement(_series(spark, d)))


def q_device_usage(spark, d):
    return rounded(S.device_usage(_series(spark, d)))


def q_moments_and_trends(spark, d):
    return rounded(S.moments_and_trends(_series(spark, d)))


def q_wear_streak_filtered(spark, d):
    return rounded(S.wear_streaks(_series(spark, d), "filtered"))


def q_wear_streak_raw(spark, d):
    return rounded(S.wear_streaks(_series(spark, d), "raw"))


def q_series_features(spark, d):
    return rounded(S.series_features(_series(spark, d)))


def q_series_features_raw(spark, d):
    return rounded(S.series_features(_series(spark, d), wear_scope="raw"))


def q_series_describe(spark, d):
    return rounded(S.series_describe(_series(spark, d)))


def q_distance_by_grain(spark, d):
    return rounded(S.distance_by_grain(_series(spark, d)))


# -------------------------------------------------------- participants
def q_ordinal_target(spark, d):
    return rounded(_participants_t(spark, d).select("id", "recalc_sii", "sii", "complete_resp_total"))


def q_health_features(spark, d):
    h = health_features(B.participants(spark, d))
    return rounded(h.select("id", "physical_health_index", "fitness_endurance_score", "height_norm", "weight_norm",
                            "fat_to_lean_mass_ratio", "computer_engagement", "cumulative_paq", "fgc_percentage",
                            "missing_health_data"))


def q_model_table(spark, d):
    feats = S.series_features(_series(spark, d))
    mt = build_model_table(B.participants(spark, d), feats, SEASONS_B,
                           target_kwargs=dict(items=B.ITEM_COLS, total="pciat_pciat_total", bands=B.BINDING_BANDS))
    return rounded(mt)


def q_encode_per_table(spark, d):
    return encode_per_table(B.participants(spark, d), SEASONS_B).select("id", *SEASONS_B)


def q_encode_shared(spark, d):
    _, test = encode_shared(B.participants(spark, d), B.cohort_b(spark, d), SEASONS_B)
    return test.select("id", *SEASONS_B)


def q_schema_align(spark, d):
    train = _participants_t(spark, d)
    return rounded(align_train(train, B.cohort_b(spark, d)))


# ------------------------------------------------------------ profiles
def q_missing_report(spark, d):
    return rounded(PR.missing_triage(PR.missing_report(B.participants(spark, d))))


def q_missing_report_wide(spark, d):
    return rounded(PR.transpose_report(PR.missing_report(B.participants(spark, d)), B.PARTICIPANT_COLUMNS))


def q_class_distribution(spark, d):
    return rounded(PR.class_distribution(_participants_t(spark, d), "sii", SII_LABELS))


def q_distribution_by_age(spark, d):
    return rounded(PR.distribution_tables(_participants_t(spark, d), "basic_demos_age", "sii", SII_LABELS))


def q_target_audit(spark, d):
    return rounded(PR.target_audit(_participants_t(spark, d), "recalc_sii", "pciat_pciat_total"))


def q_age_median_split(spark, d):
    return rounded(PR.split_median(_participants_t(spark, d), "complete_resp_total", "basic_demos_age"))


def q_bucket_report(spark, d):
    return rounded(PR.bucket_report(_participants_t(spark, d), "physical_height", 4, "complete_resp_total",
                                    "sii", SII_LABELS))


def q_score_histogram(spark, d):
    return rounded(PR.histogram(_participants_t(spark, d), "pciat_pciat_total", 20))


def q_corr_table(spark, d):
    return rounded(PR.correlation_table(_participants_t(spark, d).where(F.col("sii").isNotNull()),
                                        PHYSICAL, "complete_resp_total"))


def q_head_rows(spark, d):
    p = B.participants(spark, d)
    return rounded(p.orderBy("id").limit(5).select("id", "basic_demos_age", "physical_height", "physical_weight"))


def q_weight_floor_sorted(spark, d):
    p = B.participants(spark, d)
    return rounded(p.where(F.col("physical_weight") >= 10).orderBy("physical_weight", "id")
                   .select("id", "physical_weight"))


# ------------------------------------------------------------- metrics
def _scored(spark, d):
    s = B.scored(spark, d)
    return s.withColumn("p", M.threshold_round(F.col("score"))).withColumn("p_b", M.threshold_round(F.col("score_b")))


def q_qwk(spark, d):
    return rounded(M.qwk(_scored(spark, d), "y", "p"))


def q_cohen_kappa(spark, d):
    return rounded(M.cohen_kappa(_scored(spark, d), "y", "p"))


def q_confusion(spark, d):
    return M.confusion(_scored(spark, d), "y", "p")


def q_class_report(spark, d):
    return rounded(M.class_report(_scored(spark, d), "y", "p"))


def q_regression_summary(spark, d):
    return rounded(M.regression_summary(_scored(spark, d), "y", "p"))


def q_threshold_grid(spark, d):
    return rounded(M.threshold_grid(B.scored(spark, d), "y", "score", step=0.1))


def q_majority_vote(spark, d):
    s = _scored(spark, d)
    return s.select("id", "p", "p_b", M.majority_vote(["p", "p_b"]).alias("vote"),
                    M.half_even_class(F.col("score")).alias("rounded"))


def q_stratified_folds(spark, d):
    f = stratified_folds(B.scored(spark, d), "y", "id", 5, 42)
    return f.groupBy("y", "fold").agg(F.count(F.lit(1)).alias("n"))


def q_fold_assignment(spark, d):
    return stratified_folds(B.scored(spark, d).select("id", "y"), "y", "id", 5, 42).select("id", "y", "fold")


def _shared(spark, name):
    """A new path in the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_submission_vote(spark, d):
    """Two submissions written as CSV, read back, joined, voted on; the vote
    written and read again."""
    s = _scored(spark, d)
    paths = []
    for i, c in enumerate(("p", "p_b")):
        paths.append(_shared(spark, f"submission-{i}"))
        write_csv(s.select("id", F.col(c).alias("sii")), paths[-1])
    vote = vote_submissions([read_csv(spark, p, "id long, sii int")[0] for p in paths])
    final = _shared(spark, "submission")
    write_csv(vote, final)
    return read_csv(spark, final, "id long, sii_0 int, sii_1 int, sii int")[0]


def q_series_store(spark, d):
    """The series written as a store with a folder per id, then the id taken
    from the folder (one scan) and from the path of every file (recursive
    scan): rows, steps and magnitude per id both ways."""
    path = _shared(spark, "series-store")
    write_parquet(_series(spark, d), path, partition_by="id")
    from_folder = read_series(spark, path).groupBy("id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("step").alias("first_step"), F.max("step").alias("last_step"), F.sum("enmo").alias("enmo"))
    from_path = read_with_lineage(spark, path).groupBy("id").agg(F.count(F.lit(1)).alias("n_listed"), F.sum("light").alias("light"))
    return rounded(from_folder.join(from_path, "id", "full").withColumn("id", F.col("id").cast("long")))


def _model_rows(spark, d):
    """The full model table, stored: rows with a class, rows without, features."""
    from pulsegrid.plans.modelling import feature_columns
    mt = build_model_table(B.participants(spark, d), S.series_features(_series(spark, d)), SEASONS_B,
                           target_kwargs=dict(items=B.ITEM_COLS, total="pciat_pciat_total", bands=B.BINDING_BANDS))
    ensure_checkpoint_dir(spark)
    mt = mt.checkpoint(eager=True)  # bins, medians and folds read it
    feats = feature_columns(mt, ["id", "recalc_sii", "complete_resp_total", "pciat_pciat_total", *B.ITEM_COLS])
    return mt.where(F.col("recalc_sii").isNotNull()), mt.where(F.col("recalc_sii").isNull()), feats


def q_oof_predictions(spark, d):
    """Both voting ensembles on the full model table: out-of-fold scores of the
    rows with a class, and (fold and y null) bagged scores of the rows without."""
    from pulsegrid.plans.modelling import train_ensembles, voting_ensembles
    train, test, feats = _model_rows(spark, d)
    scores = train_ensembles(train, test, "recalc_sii", feats, voting_ensembles(), nominal=SEASONS_B).checkpoint(eager=True)
    oof = scores.where("side = 'validation'").select("ensemble", "id", "fold", F.col("y").cast("int").alias("y"), "score")
    bagged = scores.where("side = 'test'").groupBy("ensemble", "id").agg(F.avg("score").alias("score"))
    return rounded(oof.unionByName(bagged, allowMissingColumns=True))


QUERIES = {
    "daypart_activity": q_daypart_activity,
    "sleep_quality": q_sleep_quality,
    "intensity_ratios": q_intensity_ratios,
    "circadian": q_circadian,
    "movement_entropy": q_movement_entropy,
    "ordered_movement": q_ordered_movement,
    "device_usage": q_device_usage,
    "moments_and_trends": q_moments_and_trends,
    "wear_streak_filtered": q_wear_streak_filtered,
    "wear_streak_raw": q_wear_streak_raw,
    "series_features": q_series_features,
    "series_features_raw": q_series_features_raw,
    "series_describe": q_series_describe,
    "distance_by_grain": q_distance_by_grain,
    "ordinal_target": q_ordinal_target,
    "health_features": q_health_features,
    "model_table": q_model_table,
    "encode_per_table": q_encode_per_table,
    "encode_shared": q_encode_shared,
    "schema_align": q_schema_align,
    "missing_report": q_missing_report,
    "missing_report_wide": q_missing_report_wide,
    "class_distribution": q_class_distribution,
    "distribution_by_age": q_distribution_by_age,
    "target_audit": q_target_audit,
    "age_median_split": q_age_median_split,
    "bucket_report": q_bucket_report,
    "score_histogram": q_score_histogram,
    "corr_table": q_corr_table,
    "head_rows": q_head_rows,
    "weight_floor_sorted": q_weight_floor_sorted,
    "qwk": q_qwk,
    "cohen_kappa": q_cohen_kappa,
    "confusion": q_confusion,
    "class_report": q_class_report,
    "regression_summary": q_regression_summary,
    "threshold_grid": q_threshold_grid,
    "majority_vote": q_majority_vote,
    "submission_vote": q_submission_vote,
    "series_store": q_series_store,
    "stratified_folds": q_stratified_folds,
    "fold_assignment": q_fold_assignment,
    "oof_predictions": q_oof_predictions,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Participants left-joined with their series features (the central result)."""
    return q_model_table(spark, sf_dir)
