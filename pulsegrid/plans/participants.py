"""Participant-level features: ordinal target, health measures, scaling.

All operators are row-local column expressions except the scaler, whose
statistics are one global aggregate row (fitted once, inlined as literals).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.nulls import all_present, any_missing, null_count, skipnull_sum, strict_sum
from pulsegrid.functions.numeric import safe_div
from pulsegrid.operators.fitted import fitted

# Questionnaire layout and class bands of the source study.
ITEM_COUNT = 20
ITEM_MAX = 5
DEFAULT_BANDS = (30, 49, 79)
SII_LABELS = ["0 (None)", "1 (Mild)", "2 (Moderate)", "3 (Severe)"]
ITEM_COLUMNS = [f"pciat_pciat_{i + 1:02d}" for i in range(ITEM_COUNT)]
TOTAL_COLUMN = "pciat_pciat_total"
TARGET_COLUMNS = ["recalc_sii", "sii", "complete_resp_total"]

# Input columns of the health features (snake_case of the source names).
HEALTH_INPUTS = {
    "bmi": "physical_bmi", "waist": "physical_waist_circumference",
    "diastolic": "physical_diastolic_bp", "systolic": "physical_systolic_bp",
    "height": "physical_height", "weight": "physical_weight",
    "max_stage": "fitness_endurance_max_stage", "time_mins": "fitness_endurance_time_mins",
    "time_sec": "fitness_endurance_time_sec",
    "fat": "bia_bia_fat", "ffm": "bia_bia_ffm",
    "hours_day": "preint_eduhx_computerinternet_hoursday",
    "paq_a": "paq_a_paq_a_total", "paq_c": "paq_c_paq_c_total",
}
FGC_COLUMNS = ["fgc_fgc_cu", "fgc_fgc_cu_zone", "fgc_fgc_gsnd", "fgc_fgc_gsnd_zone", "fgc_fgc_gsd", "fgc_fgc_gsd_zone"]
HEALTH_FEATURES = ["physical_health_index", "fitness_endurance_score", "height_norm", "weight_norm",
                   "fat_to_lean_mass_ratio", "computer_engagement", "cumulative_paq", "fgc_percentage",
                   "missing_health_data"]


def require_columns(df: DataFrame, cols: Sequence[str], what: str = "input") -> None:
    """Plan-time schema check (raises before any job runs)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"Missing {what} columns: {missing}")


def ordinal_class(total: Column, n_missing: Column, bands=DEFAULT_BANDS, item_max: int = ITEM_MAX) -> Column:
    """Class 0..3 only when both the observed total and the largest total the
    missing items could still reach fall in the same band; else null."""
    b0, b1, b2 = bands
    best = total + n_missing * item_max
    return (F.when((total <= b0) & (best <= b0), 0)
            .when(total.between(b0 + 1, b1) & (best <= b1), 1)
            .when(total.between(b1 + 1, b2) & (best <= b2), 2)
            .when((total >= b2 + 1) & (best >= b2 + 1), 3)
            .cast("int"))


def add_target(df: DataFrame, items: Sequence[str] = ITEM_COLUMNS, total: str = TOTAL_COLUMN,
               bands=DEFAULT_BANDS, item_max: int = ITEM_MAX) -> DataFrame:
    """recalc_sii (int 0..3 or null), sii (label or null: a missing class is
    not a category), complete_resp_total (total only if every item answered)."""
    require_columns(df, [*items, total])
    code = ordinal_class(F.col(total), null_count(items), bands, item_max)
    label = F.element_at(F.array(*[F.lit(x) for x in SII_LABELS]), code + 1)
    return (df.withColumn("recalc_sii", code)
            .withColumn("sii", F.when(code.isNotNull(), label))
            .withColumn("complete_resp_total", F.when(all_present(items), F.col(total))))


def health_features(df: DataFrame, cols: dict | None = None, fgc: Sequence[str] = FGC_COLUMNS) -> DataFrame:
    """Nine health features. Strict null arithmetic except the FGC share
    (missing counts as 0, divisor fixed); height / weight z-scores use the
    population std of this table (a one-row aggregate, a scalar subquery)."""
    c = {**HEALTH_INPUTS, **(cols or {})}
    require_columns(df, [c["height"], c["weight"]], "scaling")
    require_columns(df, list(fgc), "FGC")
    col = lambda k: F.col(c[k])
    # scaler fit: one global aggregate row inside the plan
    st = fitted(df.agg(F.avg(c["height"]).alias("hm"), F.stddev_pop(c["height"]).alias("hs"),
                        F.avg(c["weight"]).alias("wm"), F.stddev_pop(c["weight"]).alias("ws")))

    def z(x, m, s):
        # a constant column scales by 1, as the standard scaler does
        return _zs(x, st[m], st[s])

    out = (df
           .withColumn("physical_health_index", strict_sum([col("bmi"), col("waist"), col("diastolic"), col("systolic")]) / 4)
           .withColumn("fitness_endurance_score", col("max_stage") + (col("time_mins") * 60 + col("time_sec")))
           .withColumn("height_norm", z(col("height"), "hm", "hs"))
           .withColumn("weight_norm", z(col("weight"), "wm", "ws"))
           .withColumn("fat_to_lean_mass_ratio", safe_div(col("fat"), col("ffm")))
           .withColumn("computer_engagement", col("hours_day") * 7)
           .withColumn("cumulative_paq", col("paq_a") + col("paq_c"))
           .withColumn("fgc_percentage", skipnull_sum(fgc) / len(fgc))
           .withColumn("missing_health_data", any_missing([col("bmi"), col("height"), col("weight")]).cast("int")))
    return out


def zscore(df: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """Population-std z-scores fitted on this table (one aggregate row, a scalar subquery)."""
    st = fitted(df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
                        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)]))
    out = df
    for i, c in enumerate(columns):
        out = out.withColumn(f"{c}{suffix}", _zs(F.col(c), st[f"m{i}"], st[f"s{i}"]))
    return out


def _zs(x: Column, mean: Column, sd: Column) -> Column:
    return (x - mean) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)
