"""Model table: participants + target + health features + series features,
aligned to the scoring cohort's columns and category-encoded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from pulsegrid.operators.encode import encode_per_table, encode_shared
from pulsegrid.operators.schema import align_to
from pulsegrid.plans.participants import TARGET_COLUMNS, add_target, health_features

# The categorical season columns of the source table (snake_case).
SEASON_COLUMNS = [
    "basic_demos_enroll_season", "cgas_season", "physical_season", "fitness_endurance_season", "fgc_season",
    "bia_season", "paq_a_season", "paq_c_season", "sds_season", "preint_eduhx_season",
]


def attach_series(participants: DataFrame, features: DataFrame, key: str = "id") -> DataFrame:
    """Left join: participants without a series keep null features.
    Both sides are one row per id; Spark picks broadcast or sort-merge from
    measured sizes (AQE)."""
    return participants.join(features, key, "left")


def build_model_table(participants: DataFrame, features: DataFrame | None = None,
                      season_columns: Sequence[str] | None = None, with_target: bool = True,
                      target_kwargs: dict | None = None, health_kwargs: dict | None = None,
                      order_by: str = "id") -> DataFrame:
    """Target (train side), health features, series join, per-table encoding."""
    df = add_target(participants, **(target_kwargs or {})) if with_target else participants
    df = health_features(df, **(health_kwargs or {}))
    if features is not None:
        df = attach_series(df, features)
    cats = [c for c in (season_columns or SEASON_COLUMNS) if c in df.columns]
    return encode_per_table(df, cats, order_by) if cats else df


def align_train(train: DataFrame, test: DataFrame, keep: Sequence[str] = tuple(TARGET_COLUMNS)) -> DataFrame:
    """Drop train-only columns except the target columns."""
    return align_to(train, test, keep)


def encode_pair(train: DataFrame, test: DataFrame, columns: Sequence[str], mode: str = "per_table",
                order_by: str = "id") -> tuple[DataFrame, DataFrame]:
    """``per_table``: each table its own codes (as the source); ``shared``: fit on train."""
    if mode == "per_table":
        return encode_per_table(train, columns, order_by), encode_per_table(test, columns, order_by)
    if mode == "shared":
        return encode_shared(train, test, columns, order_by)
    raise ValueError(f"mode must be 'per_table' or 'shared', got {mode!r}")
