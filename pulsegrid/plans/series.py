"""Per-subject features of a wrist-sensor series (58 values per id).

Input: a long series table, one row per step (see ``SERIES_SCHEMA``).
All features are computed on the rows where the device was worn
(``non_wear_flag == 0``); the wear features (ratio, distinct flags, longest
wear streak) use the same rows in ``wear_scope="filtered"`` (as the source
did, which makes them constants) or the raw rows in ``wear_scope="raw"``.

Plan shape (no step holds a whole subject in one task):

* one scan, derived columns, wear filter (pushed into the Parquet scan), and
  one exchange of the rows by (id, step chunk) that all passes read
  (``by_chunk``);
* per-id statistics: mergeable aggregates + exact quantiles (sorted in place
  for ids of few rows, a refined histogram for the others);
* ordered columns (lag of the arm angle, 12-row rolling mean, row position)
  through chunked windows with a halo fix-up (``operators.sequence``);
* one wide ``groupBy(id)`` for the single-level features;
* one ``GROUPING SETS`` aggregate for the two-level features
  ((id,hour), (id,weekday), (id,bucket), (id,date), (id,flag)), folded in
  its chunk first, then a second ``groupBy(id)``;
* a join of the per-id results on ``id`` (all one row per id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.functions.nulls import share_true
from pulsegrid.functions.numeric import corrected_kurtosis, corrected_skewness, guarded_cv, safe_div
from pulsegrid.functions.timeparts import DAY_PARTS, day_part, hour_of_day, time_of_day_ns, weekend_flag
from pulsegrid.operators.quantiles import array_quantile, decile_probs, exact_quantiles, qcut_bucket
from pulsegrid.operators.sequence import DEFAULT_CHUNK_ROWS, attach_by_chunk, longest_run, ordered_window

SERIES_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("step", T.LongType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
    T.StructField("z", T.DoubleType()),
    T.StructField("enmo", T.DoubleType()),
    T.StructField("anglez", T.DoubleType()),
    T.StructField("non_wear_flag", T.IntegerType()),
    T.StructField("light", T.DoubleType()),
    T.StructField("battery_voltage", T.DoubleType()),
    T.StructField("time_of_day", T.LongType()),
    T.StructField("weekday", T.IntegerType()),
    T.StructField("quarter", T.IntegerType()),
    T.StructField("relative_date", T.IntegerType()),
])

# Fixed values of the feature definitions.
STEP_SECONDS = 5
ROLLING_ROWS = 12
POSITION_CHANGE_DEG = 45
DIRECTION_CHANGE_DEG = 30
DARK_LIGHT_LUX = 50
ENTROPY_BUCKETS = 10
MOMENT_COLUMNS = ["x", "y", "z", "enmo", "anglez"]

# Feature names in the source's output order (stat_0 .. stat_57).
FEATURE_NAMES = (
    [f"{p}_{s}" for p in DAY_PARTS for s in ("activity_mean", "activity_std", "enmo_mean")]
    + ["sleep_movement_mean", "sleep_movement_std", "sleep_disruption_count", "light_exposure_during_sleep",
       "sleep_position_changes", "good_sleep_cycle",
       "sedentary_time_ratio", "moderate_activity_ratio", "vigorous_activity_ratio", "activity_peaks_per_day",
       "circadian_regularity", "peak_activity_hour", "trough_activity_hour", "activity_range",
       "movement_entropy", "direction_changes", "sustained_activity_periods",
       "weekend_activity_ratio", "weekend_sleep_difference",
       "wear_time_ratio", "wear_consistency", "longest_wear_streak",
       "screen_time_proxy", "dark_environment_ratio", "light_variation",
       "battery_drain_rate", "battery_variability", "low_battery_time",
       "days_monitored", "total_active_hours", "activity_regularity"]
    + [f"{c}_{s}" for c in MOMENT_COLUMNS for s in ("skewness", "kurtosis", "trend")]
)
assert len(FEATURE_NAMES) == 58


def stat_aliases(df: DataFrame, names=FEATURE_NAMES) -> DataFrame:
    """Rename features to the positional ``stat_i`` names of the source's CSV."""
    return df.select("id", *[F.col(n).alias(f"stat_{i}") for i, n in enumerate(names)])


# ------------------------------------------------------------------ rows
def derive(series: DataFrame) -> DataFrame:
    """Add magnitude, hour, night / weekend masks (row-local, no shuffle)."""
    tod = time_of_day_ns(F.col("time_of_day"))
    return _masked(series.withColumn("hour", hour_of_day(tod)))


def _masked(rows: DataFrame) -> DataFrame:
    return (rows
            .withColumn("mag", F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z")))
            .withColumn("night", day_part(F.col("hour"), "night"))
            .withColumn("weekend", weekend_flag(F.col("weekday"))))


def wear_rows(series: DataFrame) -> DataFrame:
    """Rows where the device was worn; the filter reaches the Parquet scan."""
    return derive(series.where(F.col("non_wear_flag") == 0))


# Columns of a wear row that cross the exchange, and their types behind it.
_PACKED = {"_place": "long", "x": "double", "y": "double", "z": "double", "enmo": "double", "anglez": "double", "light": "double",
           "battery_voltage": "double", "hour": "int", "weekday": "int", "relative_date": "int"}
_NO_STEP = -(1 << 62)  # chunk of rows without a step: counted, but in no order


def by_chunk(rows: DataFrame, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """The wear rows dealt once by (id, ``_chunk``); rows without id are left out.

    The values cross the exchange as one array, so every pass over the rows,
    whatever columns it uses, reads the same exchange. Aggregates by (id,
    chunk, ...) need no other one."""
    chunk = F.floor(F.col("step") / F.lit(chunk_rows))
    place = F.col("step") - chunk * chunk_rows
    values = F.array(*[(place if c == "_place" else F.col(c)).cast("double") for c in _PACKED])
    dealt = (rows.where(F.col("id").isNotNull()).select("id", F.coalesce(chunk, F.lit(_NO_STEP)).alias("_chunk"), values.alias("_values"))
             .repartition("id", "_chunk"))
    cols = dealt.select("id", "_chunk", *[F.col("_values")[i].cast(t).alias(c) for i, (c, t) in enumerate(_PACKED.items())])
    step = F.when(F.col("_chunk") != _NO_STEP, F.col("_chunk") * chunk_rows + F.col("_place"))
    return _masked(cols.select("id", "_chunk", step.alias("step"), *[c for c in _PACKED if c != "_place"], F.lit(0).alias("non_wear_flag")))


_EDGE_PROBS = decile_probs(ENTROPY_BUCKETS)
_QSPEC = {  # metric -> (column, probs, output names)
    0: ("mag", _EDGE_PROBS + [0.95], [f"mag_e{i}" for i in range(len(_EDGE_PROBS))] + ["mag_p95"]),
    1: ("light", [0.25, 0.75], ["light_p25", "light_p75"]),
    2: ("battery_voltage", [0.1], ["battery_p10"]),
}
SMALL_ROWS = 1 << 12  # ids of up to so many rows have their values sorted in one place


def id_quantiles(rows: DataFrame, metrics=(0, 1, 2), small_rows: int = SMALL_ROWS) -> DataFrame:
    """All per-id quantiles of one feature run, from rows ``by_chunk``. Ids of
    up to ``small_rows`` rows sort their values; those of the others are
    stacked into (id, metric, value) and share one exact-quantile pass."""
    values = {m: F.col(_QSPEC[m][0]).cast("double") for m in metrics}
    counts = rows.groupBy("id", "_chunk").agg(F.count(F.lit(1)).alias("_cnt"))
    told = rows.join(counts.select("id", "_chunk", F.sum("_cnt").over(Window.partitionBy("id")).alias("_total")), ["id", "_chunk"])
    small = told.where(F.col("_total") <= small_rows).groupBy("id").agg(*[F.sort_array(F.collect_list(c)).alias(f"_v{m}") for m, c in values.items()])
    small = small.select("id", *[array_quantile(F.col(f"_v{m}"), p).alias(n) for m in metrics for p, n in zip(*_QSPEC[m][1:], strict=True)])

    probs = sorted({p for m in metrics for p in _QSPEC[m][1]})
    stacked = told.where(F.col("_total") > small_rows).select("id", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), c.alias("value")) for m, c in values.items()
    ])).alias("s")).select("id", "s.metric", "s.value")
    q = exact_quantiles(stacked, ["id", "metric"], "value", probs, names=[f"p{i}" for i in range(len(probs))])
    out = []
    for m in metrics:
        for p, n in zip(*_QSPEC[m][1:], strict=True):
            out.append(F.max(F.when(F.col("metric") == m, F.col(f"p{probs.index(p)}"))).alias(n))
    return small.unionByName(q.groupBy("id").agg(*out))


def sequenced(rows: DataFrame, chunk_rows: int = DEFAULT_CHUNK_ROWS, carry: DataFrame | None = None,
              counts: DataFrame | None = None) -> DataFrame:
    """Ordered columns over the wear rows of each id (by step):
    ``d_anglez`` = |anglez - previous anglez|, ``roll_mag`` = 12-row mean
    (null until 12 rows), ``pos`` = 0-based row position. ``carry``: per-id
    statistics attached through the chunk table (no shuffle of rows by id)."""
    def cols(w):
        r = w.rowsBetween(-(ROLLING_ROWS - 1), 0)
        return {
            "d_anglez": F.abs(F.col("anglez") - F.lag("anglez", 1).over(w)),
            "roll_mag": F.when(F.count("mag").over(r) == ROLLING_ROWS, F.avg("mag").over(r)),
        }
    return ordered_window(rows, "id", "step", cols, halo=ROLLING_ROWS - 1, chunk_rows=chunk_rows, position="pos",
                          carry=carry, counts=counts)


# ---------------------------------------------------------- feature groups
def _daypart_aggs():
    out = []
    for p in DAY_PARTS:
        m = day_part(F.col("hour"), p)
        out += [F.avg(F.when(m, F.col("mag"))).alias(f"{p}_activity_mean"),
                F.stddev_samp(F.when(m, F.col("mag"))).alias(f"{p}_activity_std"),
                F.avg(F.when(m, F.col("enmo"))).alias(f"{p}_enmo_mean")]
    return out


def _thr():
    return F.col("mag_mean") + F.col("mag_std")


def _sleep_aggs():
    night = F.col("night")
    night_light = F.avg(F.when(night, F.col("light")))
    return [
        F.avg(F.when(night, F.col("mag"))).alias("sleep_movement_mean"),
        F.stddev_samp(F.when(night, F.col("mag"))).alias("sleep_movement_std"),
        F.count_if(F.coalesce(night & (F.col("mag") > F.col("mag_mean") + 2 * F.col("mag_std")), F.lit(False)))
        .cast("long").alias("sleep_disruption_count"),
        night_light.alias("light_exposure_during_sleep"),
        F.count_if(F.coalesce(night & (F.col("d_anglez") > POSITION_CHANGE_DEG), F.lit(False)))
        .cast("long").alias("sleep_position_changes"),
        F.coalesce((night_light < DARK_LIGHT_LUX).cast("int"), F.lit(0)).alias("good_sleep_cycle"),
    ]


def _intensity_aggs():
    thr = _thr()
    mag = F.col("mag")
    return [
        share_true(mag < thr * 0.5).alias("sedentary_time_ratio"),
        share_true((mag >= thr * 0.5) & (mag < thr * 1.5)).alias("moderate_activity_ratio"),
        share_true(mag >= thr * 1.5).alias("vigorous_activity_ratio"),
        F.count_if(F.coalesce(mag > F.col("mag_p95"), F.lit(False))).alias("_peaks"),
        (F.count_if(F.coalesce(mag > thr * 0.5, F.lit(False))) * STEP_SECONDS / 3600.0).alias("total_active_hours"),
    ]


def _movement_aggs():
    n = F.count(F.lit(1))
    return [
        (F.count_if(F.coalesce(F.col("d_anglez") > DIRECTION_CHANGE_DEG, F.lit(False))) / n).alias("direction_changes"),
        (F.count_if(F.coalesce(F.col("roll_mag") > _thr(), F.lit(False))) / n).alias("sustained_activity_periods"),
        safe_div(F.avg(F.when(F.col("weekend"), F.col("mag"))), F.avg(F.when(~F.col("weekend"), F.col("mag"))))
        .alias("weekend_activity_ratio"),
        (F.avg(F.when(F.col("weekend") & F.col("night"), F.col("mag")))
         - F.avg(F.when(~F.col("weekend") & F.col("night"), F.col("mag")))).alias("weekend_sleep_difference"),
    ]


def _device_aggs():
    light, batt = F.col("light"), F.col("battery_voltage")
    return [
        share_true(light > F.col("light_p75")).alias("screen_time_proxy"),
        share_true(light < F.col("light_p25")).alias("dark_environment_ratio"),
        guarded_cv(F.stddev_samp(light), F.avg(light)).alias("light_variation"),
        (-F.regr_slope(batt, F.col("pos").cast("double"))).alias("battery_drain_rate"),
        F.stddev_samp(batt).alias("battery_variability"),
        share_true(batt < F.col("battery_p10")).alias("low_battery_time"),
    ]


def _moment_aggs():
    out = []
    for c in MOMENT_COLUMNS:
        out += [corrected_skewness(c).alias(f"{c}_skewness"),
                corrected_kurtosis(c).alias(f"{c}_kurtosis"),
                F.regr_slope(F.col(c), F.col("pos").cast("double")).alias(f"{c}_trend")]
    return out


def _wear_aggs():
    flag = F.col("non_wear_flag")
    return [share_true(flag == 0).alias("wear_time_ratio")]


# Level tags of the two-level features.
_LEVELS = {"hour": 1, "weekday": 2, "bucket": 3, "relative_date": 4, "non_wear_flag": 5}


def _expand_levels(rows: DataFrame, levels) -> DataFrame:
    """One copy of each row per requested level, keyed by (id, lvl, lk):
    the GROUPING SETS expansion written out."""
    tags = [_LEVELS[lv] for lv in levels]
    lk = F.lit(None).cast("long")
    for lv in levels:
        lk = F.when(F.col("lvl") == _LEVELS[lv], F.col(lv).cast("long")).otherwise(lk)
    return (rows.withColumn("lvl", F.explode(F.array(*[F.lit(t) for t in tags])))
            .withColumn("lk", lk)
            .where(F.col("lk").isNotNull()))


def _level_rows(rows: DataFrame, levels) -> DataFrame:
    """Per (id, lvl, lk): mean magnitude ``m``, from rows ``by_chunk``: folded
    in the chunk first, so that a row a chunk and level value goes to its id."""
    g = _expand_levels(rows, levels).groupBy("id", "_chunk", "lvl", "lk").agg(F.sum("mag").alias("s"), F.count("mag").alias("c"))
    return (g.select("id", F.col("lvl").cast("byte").alias("lvl"), "lk", "s", "c").repartition("id")
            .groupBy("id", "lvl", "lk").agg(safe_div(F.sum("s"), F.sum("c")).alias("m")))


def _level_partials():
    return [F.avg("mag").alias("m"), F.count(F.lit(1)).alias("cnt")]


def _second_level(levels):
    def at(level):
        return F.col("lvl") == _LEVELS[level]

    hm = F.when(at("hour"), F.col("m"))
    aggs = []
    if "hour" in levels:
        aggs += [
            safe_div(F.stddev_samp(hm), F.avg(hm)).alias("circadian_regularity"),
            F.max_by(F.col("lk"), F.when(at("hour") & F.col("m").isNotNull(),
                                         F.struct(F.col("m"), -F.col("lk")))).cast("int").alias("peak_activity_hour"),
            F.min_by(F.col("lk"), F.when(at("hour") & F.col("m").isNotNull(),
                                         F.struct(F.col("m"), F.col("lk")))).cast("int").alias("trough_activity_hour"),
            (F.max(hm) - F.min(hm)).alias("activity_range"),
        ]
    if "bucket" in levels:
        aggs += [F.sum(F.when(at("bucket"), F.col("cnt") * F.log(F.col("cnt")))).alias("_sclogc"),
                 F.sum(F.when(at("bucket"), F.col("cnt"))).alias("_btot")]
    if "weekday" in levels:
        aggs.append(F.stddev_samp(F.when(at("weekday"), F.col("m"))).alias("activity_regularity"))
    if "relative_date" in levels:
        aggs.append(F.count_if(at("relative_date")).alias("days_monitored"))
    if "non_wear_flag" in levels:
        aggs.append(F.count_if(at("non_wear_flag")).alias("wear_consistency"))
    return aggs


def _finish_levels(out: DataFrame, levels) -> DataFrame:
    if "bucket" in levels:
        # entropy = -sum p ln p with p = c / N  ==  ln N - sum(c ln c) / N
        out = out.withColumn("movement_entropy", F.log(F.col("_btot")) - F.col("_sclogc") / F.col("_btot"))
        out = out.drop("_sclogc", "_btot")
    return out


def two_level(rows: DataFrame, levels=("hour", "weekday", "bucket", "relative_date", "non_wear_flag")) -> DataFrame:
    """Second-level features from one expanded, map-side combined pass."""
    g = _expand_levels(rows, levels).groupBy("id", "lvl", "lk").agg(*_level_partials())
    return _finish_levels(g.groupBy("id").agg(*_second_level(levels)), levels)


def _bucket_counters():
    """Sizes of the equal-frequency buckets: a bounded set of counters."""
    return [F.count_if(F.col("bucket") == b).alias(f"_b{b}") for b in range(1, ENTROPY_BUCKETS + 1)]


def _entropy_from_counters():
    """-sum p ln p over non-empty buckets, p = c / N  ==  ln N - sum(c ln c) / N."""
    sizes = [F.col(f"_b{b}") for b in range(1, ENTROPY_BUCKETS + 1)]
    total = sum(sizes)
    clogc = sum(F.when(c > 0, c * F.log(c)).otherwise(F.lit(0.0)) for c in sizes)
    return F.when(total > 0, F.log(total) - clogc / total)


def _with_bucket(rows: DataFrame) -> DataFrame:
    edges = [F.col(f"mag_e{i}") for i in range(len(_EDGE_PROBS))]
    return rows.withColumn("bucket", qcut_bucket(F.col("mag"), edges))


# ------------------------------------------------------------ composites
def series_features(series: DataFrame, wear_scope: str = "filtered",
                    chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """All 58 features, one row per id (columns in ``FEATURE_NAMES`` order).

    The wear rows are dealt once by (id, chunk). From that one exchange come
    the per-id magnitude moments and exact quantiles, the per-(id, level,
    key) means (folded in the chunk before they meet by id), the chunk
    counts, and the ordered window, to which the chunk table carries the
    per-id statistics. The single-level features (including the 10 bucket
    counters of the entropy) are one aggregate keyed by id.
    """
    rows = by_chunk(wear_rows(series), chunk_rows)
    levels = ("hour", "weekday", "relative_date", "non_wear_flag")
    mom = rows.groupBy("id").agg(F.avg("mag").alias("mag_mean"), F.stddev_samp("mag").alias("mag_std"))
    stats = mom.join(id_quantiles(rows), "id", "left")
    # per-id statistics ride on the chunk table to the rows
    seq = _with_bucket(sequenced(rows, chunk_rows, carry=stats))
    single = [*_daypart_aggs(), *_sleep_aggs(), *_intensity_aggs(), *_movement_aggs(), *_device_aggs(),
              *_moment_aggs(), *_wear_aggs(), F.count(F.lit(1)).alias("_n"),
              *_bucket_counters()]
    main = seq.groupBy("id").agg(*single)
    # level features need neither order nor statistics
    lv = _level_rows(rows, levels).groupBy("id").agg(*_second_level(levels))
    out = main.join(lv, "id")
    out = out.withColumn("movement_entropy", _entropy_from_counters())
    out = out.withColumn("activity_peaks_per_day", F.col("_peaks") / F.col("days_monitored"))
    if wear_scope == "filtered":
        out = out.withColumn("longest_wear_streak", F.col("_n"))
    elif wear_scope == "raw":
        raw = wear_features_raw(series, chunk_rows)
        out = out.drop("wear_time_ratio", "wear_consistency").join(raw, "id", "left")
    else:
        raise ValueError(f"wear_scope must be 'filtered' or 'raw', got {wear_scope!r}")
    return out.select("id", *FEATURE_NAMES)


def wear_features_raw(series: DataFrame, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Wear ratio, distinct flag values and longest wear streak on all rows."""
    flag = F.col("non_wear_flag")
    agg = series.groupBy("id").agg(share_true(flag == 0).alias("wear_time_ratio"))
    distinct = (series.where(flag.isNotNull()).groupBy("id", "non_wear_flag").agg(F.lit(1).alias("_one"))
                .groupBy("id").agg(F.count(F.lit(1)).alias("wear_consistency")))
    streak = longest_run(series, "id", "step", flag == 0, "longest_wear_streak", chunk_rows)
    return agg.join(distinct, "id", "left").join(streak, "id", "left")


def daypart_activity(series: DataFrame) -> DataFrame:
    """Features 0-11: magnitude mean / std and enmo mean per day part."""
    return wear_rows(series).groupBy("id").agg(*_daypart_aggs())


def sleep_quality(series: DataFrame, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Features 12-17."""
    rows = wear_rows(series)
    mom = rows.groupBy("id").agg(F.avg("mag").alias("mag_mean"), F.stddev_samp("mag").alias("mag_std"))
    def cols(w):
        return {"d_anglez": F.abs(F.col("anglez") - F.lag("anglez", 1).over(w))}
    seq = ordered_window(rows, "id", "step", cols, halo=1, chunk_rows=chunk_rows, position=None, carry=mom)
    return seq.groupBy("id").agg(*_sleep_aggs())


def intensity_ratios(series: DataFrame) -> DataFrame:
    """Features 18-21 and 41 (needs the per-id p95, so one quantile pass)."""
    rows = wear_rows(series)
    mom = rows.groupBy("id").agg(F.avg("mag").alias("mag_mean"), F.stddev_samp("mag").alias("mag_std"),
                                 F.count_distinct("relative_date").alias("days_monitored"))
    p95 = exact_quantiles(rows, "id", "mag", [0.95], names=["mag_p95"])
    j = attach_by_chunk(rows, "id", "step", mom.join(p95, "id"))
    out = j.groupBy("id").agg(*_intensity_aggs(), F.first("days_monitored").alias("days_monitored"))
    return out.select("id", "sedentary_time_ratio", "moderate_activity_ratio", "vigorous_activity_ratio",
                      (F.col("_peaks") / F.col("days_monitored")).alias("activity_peaks_per_day"),
                      "total_active_hours")


def circadian(series: DataFrame) -> DataFrame:
    """Features 22-25 and 42 (two-level aggregates over hour and weekday)."""
    return two_level(wear_rows(series), levels=("hour", "weekday"))


def movement_entropy(series: DataFrame) -> DataFrame:
    """Feature 26: entropy of equal-frequency magnitude buckets."""
    rows = wear_rows(series)
    edges = id_quantiles(by_chunk(rows), metrics=(0,))
    b = _with_bucket(attach_by_chunk(rows, "id", "step", edges))
    return b.groupBy("id").agg(*_bucket_counters()).select("id", _entropy_from_counters().alias("movement_entropy"))


def ordered_movement(series: DataFrame, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Features 16, 27, 28 (lag and rolling windows in step order)."""
    rows = wear_rows(series)
    mom = rows.groupBy("id").agg(F.avg("mag").alias("mag_mean"), F.stddev_samp("mag").alias("mag_std"))
    seq = sequenced(rows, chunk_rows, carry=mom)
    n = F.count(F.lit(1))
    night = F.col("night")
    return seq.groupBy("id").agg(
        F.count_if(F.coalesce(night & (F.col("d_anglez") > POSITION_CHANGE_DEG), F.lit(False)))
        .cast("long").alias("sleep_position_changes"),
        (F.count_if(F.coalesce(F.col("d_anglez") > DIRECTION_CHANGE_DEG, F.lit(False))) / n).alias("direction_changes"),
        (F.count_if(F.coalesce(F.col("roll_mag") > _thr(), F.lit(False))) / n).alias("sustained_activity_periods"))


def device_usage(series: DataFrame, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Features 34-39 (light and battery)."""
    rows = by_chunk(wear_rows(series), chunk_rows)
    q = id_quantiles(rows, metrics=(1, 2))
    pos = ordered_window(rows, "id", "step", lambda w: {}, halo=0, chunk_rows=chunk_rows, position="pos", carry=q)
    return pos.groupBy("id").agg(*_device_aggs())


def moments_and_trends(series: DataFrame, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Features 43-57: corrected skewness, excess kurtosis, slope on row position."""
    rows = wear_rows(series)
    pos = ordered_window(rows, "id", "step", lambda w: {}, halo=0, chunk_rows=chunk_rows, position="pos")
    return pos.groupBy("id").agg(*_moment_aggs())


def wear_streaks(series: DataFrame, wear_scope: str, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Features 31-33 in either scope."""
    if wear_scope == "raw":
        return wear_features_raw(series, chunk_rows)
    rows = series.where(F.col("non_wear_flag") == 0)
    return wear_features_raw(rows, chunk_rows)


def distance_by_grain(series: DataFrame) -> DataFrame:
    """Distance (magnitude x 5 s) per id summed by day, month and quarter,
    all three grains in one GROUPING SETS pass. ``grain`` names the level."""
    rows = wear_rows(series)
    # pseudo-epoch calendar: day 0 = 1970-01-01 (time of day never crosses midnight)
    date = F.date_add(F.lit("1970-01-01").cast("date"), F.col("relative_date"))
    r = rows.select("id", (F.col("mag") * STEP_SECONDS).alias("distance"),
                    date.alias("date"), F.trunc(date, "month").alias("month"), "quarter")
    g = (r.groupingSets([["id", "date"], ["id", "month"], ["id", "quarter"]], "id", "date", "month", "quarter")
         .agg(F.sum("distance").alias("distance"), F.grouping_id().alias("gid")))
    grain = F.when(F.col("gid") == 3, "daily").when(F.col("gid") == 5, "monthly").otherwise("quarterly")
    key = F.coalesce(F.col("date").cast("string"), F.col("month").cast("string"), F.col("quarter").cast("string"))
    return g.select("id", grain.alias("grain"), key.alias("period"), "distance").where(F.col("period").isNotNull())


def series_describe(series: DataFrame, columns=("x", "y", "z", "enmo", "anglez", "light", "battery_voltage")) -> DataFrame:
    """count / mean / std / min / 25 % / 50 % / 75 % / max per id and column,
    on the unfiltered rows, with exact quantiles (``DataFrame.summary`` uses
    approximate ones). Long format: one row per (id, field)."""
    long = series.select("id", F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("value")) for c in columns])).alias("s")
    ).select("id", "s.field", "s.value")
    # plain moments: one wide aggregate, turned to rows per id afterwards; rows are copied for the quantiles only
    value = lambda c: F.col(c).cast("double")
    moments = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    wide = series.groupBy("id").agg(*[f(value(c)).alias(f"{n}_{c}") for c in columns for n, f in moments.items()])
    basic = wide.select("id", F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), *[F.col(f"{n}_{c}").alias(n) for n in moments]) for c in columns])).alias("s")).select("id", "s.*")
    q = exact_quantiles(long, ["id", "field"], "value", [0.25, 0.5, 0.75], names=["p25", "p50", "p75"])
    return basic.join(q, ["id", "field"], "left").select(
        "id", "field", "count", "mean", "std", "min", "p25", "p50", "p75", "max")

