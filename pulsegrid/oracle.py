"""DuckDB SQL equivalents of the registered queries (correctness oracle).

Written independently of the Spark plans, directly from the feature
definitions: plain window functions over whole subjects, ``quantile_cont``
for exact quantiles, CASE expressions. Views come from ``plans.bindings``
(the same expression text the Spark side uses). Doubles are rounded to 6
places on both sides.
"""

from __future__ import annotations

from pulsegrid.plans import bindings as B

D = 6
SII = ["0 (None)", "1 (Mild)", "2 (Moderate)", "3 (Severe)"]
PARTS = {"morning": "hour >= 6 AND hour < 12", "afternoon": "hour >= 12 AND hour < 18",
         "evening": "hour >= 18 AND hour < 22", "night": "hour >= 22 OR hour < 6"}
MOMENTS = ["x", "y", "z", "enmo", "anglez"]
SEASONS_B = ["basic_demos_enroll_season", "physical_season"]
PHYSICAL = ["physical_bmi", "physical_height", "physical_weight", "physical_waist_circumference",
            "physical_diastolic_bp", "physical_heartrate", "physical_systolic_bp"]


def rnd(sql: str, cols) -> str:
    # "+ 0.0" turns a rounded -0.0 into 0.0, as Spark's decimal rounding does
    rep = ", ".join(f"round({c}, {D}) + 0.0 AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) _r"


def sdiv(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN NULL ELSE ({a}) / ({b}) END)"


def share(cond: str) -> str:
    return f"avg(coalesce(CAST(({cond}) AS DOUBLE), 0.0))"


# ------------------------------------------------------------ series CTEs
def series_ctes() -> str:
    return (f"series AS {B.series_sql()}, "
            "wear AS (SELECT *, sqrt(x * x + y * y + z * z) AS mag, "
            "CAST(floor(time_of_day / 3600000000000) AS INTEGER) AS hour FROM series WHERE non_wear_flag = 0), "
            "wearx AS (SELECT *, (hour >= 22 OR hour < 6) AS night, coalesce(weekday IN (6, 7), false) AS weekend "
            "FROM wear), "
            "stats AS (SELECT id, avg(mag) AS mm, stddev_samp(mag) AS ms, count(DISTINCT relative_date) AS nd, "
            "quantile_cont(mag, 0.95) AS p95, quantile_cont(light, 0.25) AS l25, quantile_cont(light, 0.75) AS l75, "
            "quantile_cont(battery_voltage, 0.1) AS b10, "
            "quantile_cont(mag, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS qe FROM wearx GROUP BY id), "
            "seq AS (SELECT w.*, st.mm, st.ms, st.p95, st.l25, st.l75, st.b10, st.qe, "
            "row_number() OVER (PARTITION BY w.id ORDER BY step) - 1 AS pos, "
            "abs(anglez - lag(anglez) OVER (PARTITION BY w.id ORDER BY step)) AS d_anglez, "
            "CASE WHEN count(mag) OVER (PARTITION BY w.id ORDER BY step ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) = 12 "
            "THEN avg(mag) OVER (PARTITION BY w.id ORDER BY step ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) END AS roll_mag "
            "FROM wearx w JOIN stats st ON w.id = st.id)")


def _daypart_cols() -> list[tuple[str, str]]:
    out = []
    for p, c in PARTS.items():
        out += [(f"{p}_activity_mean", f"avg(CASE WHEN {c} THEN mag END)"),
                (f"{p}_activity_std", f"stddev_samp(CASE WHEN {c} THEN mag END)"),
                (f"{p}_enmo_mean", f"avg(CASE WHEN {c} THEN enmo END)")]
    return out


def _sleep_cols() -> list[tuple[str, str]]:
    return [
        ("sleep_movement_mean", "avg(CASE WHEN night THEN mag END)"),
        ("sleep_movement_std", "stddev_samp(CASE WHEN night THEN mag END)"),
        ("sleep_disruption_count", "CAST(count(*) FILTER (WHERE night AND mag > mm + 2 * ms) AS BIGINT)"),
        ("light_exposure_during_sleep", "avg(CASE WHEN night THEN light END)"),
        ("sleep_position_changes", "CAST(count(*) FILTER (WHERE night AND d_anglez > 45) AS BIGINT)"),
        ("good_sleep_cycle", "CAST(coalesce(CAST(avg(CASE WHEN night THEN light END) < 50 AS INTEGER), 0) AS INTEGER)"),
    ]


def _intensity_cols() -> list[tuple[str, str]]:
    return [
        ("sedentary_time_ratio", share("mag < (mm + ms) * 0.5")),
        ("moderate_activity_ratio", share("mag >= (mm + ms) * 0.5 AND mag < (mm + ms) * 1.5")),
        ("vigorous_activity_ratio", share("mag >= (mm + ms) * 1.5")),
        ("activity_peaks_per_day", "CAST(count(*) FILTER (WHERE mag > p95) AS DOUBLE) / count(DISTINCT relative_date)"),
        ("total_active_hours", "CAST(count(*) FILTER (WHERE mag > (mm + ms) * 0.5) * 5 AS DOUBLE) / 3600"),
    ]


def _movement_cols() -> list[tuple[str, str]]:
    return [
        ("direction_changes", "CAST(count(*) FILTER (WHERE d_anglez > 30) AS DOUBLE) / count(*)"),
        ("sustained_activity_periods", "CAST(count(*) FILTER (WHERE roll_mag > mm + ms) AS DOUBLE) / count(*)"),
        ("weekend_activity_ratio", sdiv("avg(CASE WHEN weekend THEN mag END)", "avg(CASE WHEN NOT weekend THEN mag END)")),
        ("weekend_sleep_difference",
         "avg(CASE WHEN weekend AND night THEN mag END) - avg(CASE WHEN NOT weekend AND night THEN mag END)"),
    ]


def _device_cols() -> list[tuple[str, str]]:
    return [
        ("screen_time_proxy", share("light > l75")),
        ("dark_environment_ratio", share("light < l25")),
        ("light_variation", "CASE WHEN avg(light) = 0 THEN 0.0 ELSE stddev_samp(light) / avg(light) END"),
        ("battery_drain_rate", "-regr_slope(battery_voltage, CAST(pos AS DOUBLE))"),
        ("battery_variability", "stddev_samp(battery_voltage)"),
        ("low_battery_time", share("battery_voltage < b10")),
    ]


def _moment_cols() -> list[tuple[str, str]]:
    out = []
    for c in MOMENTS:
        out += [(f"{c}_skewness", f"CASE WHEN count({c}) < 3 THEN NULL WHEN var_pop({c}) = 0 THEN 0.0 ELSE skewness({c}) END"),
                (f"{c}_kurtosis", f"CASE WHEN count({c}) < 4 THEN NULL WHEN var_pop({c}) = 0 THEN 0.0 ELSE kurtosis({c}) END"),
                (f"{c}_trend", f"regr_slope({c}, CAST(pos AS DOUBLE))")]
    return out


def _bucket_expr() -> str:
    terms = ["CAST(qe[1] < mag AS INTEGER)"] + [
        f"CAST(qe[{i}] < mag AND qe[{i}] <> qe[{i - 1}] AS INTEGER)" for i in range(2, 12)]
    return f"CASE WHEN len(list_distinct(qe)) >= 2 THEN greatest(1, {' + '.join(terms)}) END"


def _two_level_ctes() -> str:
    return (
        "hm AS (SELECT id, hour, avg(mag) AS m FROM wearx WHERE hour IS NOT NULL GROUP BY id, hour), "
        "hs AS (SELECT id, " + sdiv("stddev_samp(m)", "avg(m)") + " AS circadian_regularity, max(m) AS mx, min(m) AS mn, "
        "max(m) - min(m) AS activity_range FROM hm GROUP BY id), "
        "pk AS (SELECT hm.id, min(hour) FILTER (WHERE m = mx) AS peak_activity_hour, "
        "min(hour) FILTER (WHERE m = mn) AS trough_activity_hour FROM hm JOIN hs ON hm.id = hs.id GROUP BY hm.id), "
        "wd AS (SELECT id, stddev_samp(m) AS activity_regularity FROM (SELECT id, weekday, avg(mag) AS m FROM wearx "
        "WHERE weekday IS NOT NULL GROUP BY id, weekday) GROUP BY id), "
        f"bk AS (SELECT id, bucket FROM (SELECT id, {_bucket_expr()} AS bucket FROM seq) WHERE bucket IS NOT NULL), "
        "ent AS (SELECT id, ln(sum(c)) - sum(c * ln(c)) / sum(c) AS movement_entropy FROM "
        "(SELECT id, bucket, count(*) AS c FROM bk GROUP BY id, bucket) GROUP BY id)"
    )


def _longest_run_cte(name: str, src: str) -> str:
    return (f"{name} AS (SELECT id, CAST(max(z) AS BIGINT) AS longest_wear_streak FROM ("
            "SELECT id, grp, count(*) FILTER (WHERE non_wear_flag = 0) AS z FROM ("
            "SELECT id, non_wear_flag, sum(CASE WHEN non_wear_flag IS DISTINCT FROM 0 THEN 1 ELSE 0 END) "
            f"OVER (PARTITION BY id ORDER BY step ROWS UNBOUNDED PRECEDING) AS grp FROM {src}) GROUP BY id, grp) GROUP BY id)")


def _wear_sql(src: str) -> str:
    return (f"WITH {series_ctes()}, {_longest_run_cte('lr', src)} "
            f"SELECT a.id, a.wear_time_ratio, a.wear_consistency, lr.longest_wear_streak FROM ("
            f"SELECT id, {share('non_wear_flag = 0')} AS wear_time_ratio, "
            f"CAST(count(DISTINCT non_wear_flag) AS BIGINT) AS wear_consistency FROM {src} GROUP BY id) a "
            "LEFT JOIN lr ON a.id = lr.id")


def _agg_sql(cols: list[tuple[str, str]], src: str = "seq") -> str:
    sel = ", ".join(f"{e} AS {n}" for n, e in cols)
    return f"WITH {series_ctes()} SELECT id, {sel} FROM {src} GROUP BY id"


def series_features_raw_sql() -> str:
    """Same features, wear columns from all rows (raw scope)."""
    from pulsegrid.plans.series import FEATURE_NAMES
    base = series_features_sql()
    body = base[len("WITH "):]
    cut = body.rindex("SELECT m.id")
    ctes, _ = body[:cut].rstrip(), body[cut:]
    cols = ", ".join(f"rw.{n}" if n in ("wear_time_ratio", "wear_consistency", "longest_wear_streak") else f"f.{n}"
                     for n in FEATURE_NAMES)
    raw = (f"{_longest_run_cte('lr', 'series')}, rw AS (SELECT a.id, a.wear_time_ratio, a.wear_consistency, "
           f"lr.longest_wear_streak FROM (SELECT id, {share('non_wear_flag = 0')} AS wear_time_ratio, "
           "CAST(count(DISTINCT non_wear_flag) AS BIGINT) AS wear_consistency FROM series GROUP BY id) a "
           "LEFT JOIN lr ON a.id = lr.id)")
    return f"WITH {ctes}, {raw}, f AS ({body[cut:]}) SELECT f.id, {cols} FROM f LEFT JOIN rw ON f.id = rw.id"


def series_features_sql() -> str:
    single = _daypart_cols() + _sleep_cols() + _intensity_cols() + _movement_cols() + _device_cols() + _moment_cols()
    sel = ", ".join(f"{e} AS {n}" for n, e in single)
    from pulsegrid.plans.series import FEATURE_NAMES
    cols = ", ".join(f"m.{n}" if n in dict(single) else n for n in FEATURE_NAMES)
    return (f"WITH {series_ctes()}, {_two_level_ctes()}, "
            f"m AS (SELECT id, {sel}, {share('non_wear_flag = 0')} AS wear_time_ratio, "
            "CAST(count(DISTINCT non_wear_flag) AS BIGINT) AS wear_consistency, "
            "CAST(count(*) AS BIGINT) AS longest_wear_streak, "
            "CAST(count(DISTINCT relative_date) AS BIGINT) AS days_monitored FROM seq GROUP BY id) "
            f"SELECT m.id, {cols} FROM m JOIN hs ON m.id = hs.id JOIN pk ON m.id = pk.id "
            "JOIN wd ON m.id = wd.id LEFT JOIN ent ON m.id = ent.id")


def _series_double_cols(names) -> list[str]:
    ints = {"sleep_disruption_count", "sleep_position_changes", "good_sleep_cycle", "peak_activity_hour",
            "trough_activity_hour", "wear_consistency", "longest_wear_streak", "days_monitored"}
    return [n for n in names if n not in ints]


def series_queries() -> dict[str, str]:
    from pulsegrid.plans.series import FEATURE_NAMES
    q = {}
    q["daypart_activity"] = rnd(_agg_sql(_daypart_cols()), [n for n, _ in _daypart_cols()])
    q["sleep_quality"] = rnd(_agg_sql(_sleep_cols()), _series_double_cols([n for n, _ in _sleep_cols()]))
    q["intensity_ratios"] = rnd(_agg_sql(_intensity_cols()), [n for n, _ in _intensity_cols()])
    q["circadian"] = rnd(
        f"WITH {series_ctes()}, {_two_level_ctes()} SELECT hs.id, circadian_regularity, peak_activity_hour, "
        "trough_activity_hour, activity_range, activity_regularity FROM hs JOIN pk ON hs.id = pk.id "
        "JOIN wd ON hs.id = wd.id", ["circadian_regularity", "activity_range", "activity_regularity"])
    q["movement_entropy"] = rnd(f"WITH {series_ctes()}, {_two_level_ctes()} SELECT w.id, ent.movement_entropy "
                                "FROM (SELECT DISTINCT id FROM wearx) w LEFT JOIN ent ON w.id = ent.id",
                                ["movement_entropy"])
    om = [("sleep_position_changes", _sleep_cols()[4][1])] + _movement_cols()[:2]
    q["ordered_movement"] = rnd(_agg_sql(om), ["direction_changes", "sustained_activity_periods"])
    q["device_usage"] = rnd(_agg_sql(_device_cols()), [n for n, _ in _device_cols()])
    q["moments_and_trends"] = rnd(_agg_sql(_moment_cols()), [n for n, _ in _moment_cols()])
    q["wear_streak_filtered"] = rnd(_wear_sql("(SELECT * FROM series WHERE non_wear_flag = 0)"), ["wear_time_ratio"])
    q["wear_streak_raw"] = rnd(_wear_sql("series"), ["wear_time_ratio"])
    q["series_features"] = rnd(series_features_sql(), _series_double_cols(FEATURE_NAMES))
    q["series_features_raw"] = rnd(series_features_raw_sql(), _series_double_cols(FEATURE_NAMES))
    cols = ["x", "y", "z", "enmo", "anglez", "light", "battery_voltage"]
    long = " UNION ALL ".join(f"SELECT id, '{c}' AS field, CAST({c} AS DOUBLE) AS value FROM series" for c in cols)
    q["series_describe"] = rnd(
        f"WITH series AS {B.series_sql()}, lg AS ({long}) SELECT id, field, CAST(count(value) AS BIGINT) AS count, "
        "avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, quantile_cont(value, 0.25) AS p25, "
        "quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75, max(value) AS max "
        "FROM lg GROUP BY id, field", ["mean", "std", "min", "p25", "p50", "p75", "max"])
    dist = ("SELECT id, mag * 5 AS distance, DATE '1970-01-01' + relative_date AS d, quarter FROM wearx")
    q["distance_by_grain"] = rnd(
        f"WITH {series_ctes()}, r AS ({dist}) "
        "SELECT id, 'daily' AS grain, CAST(d AS VARCHAR) AS period, sum(distance) AS distance FROM r "
        "WHERE d IS NOT NULL GROUP BY id, d UNION ALL "
        "SELECT id, 'monthly', CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR), sum(distance) FROM r "
        "WHERE d IS NOT NULL GROUP BY id, date_trunc('month', d) UNION ALL "
        "SELECT id, 'quarterly', CAST(quarter AS VARCHAR), sum(distance) FROM r WHERE quarter IS NOT NULL "
        "GROUP BY id, quarter", ["distance"])
    return q


# ------------------------------------------------------------ participants
def _nulls(cols) -> str:
    return " + ".join(f"(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in cols)


def target_cte(src: str = "p") -> str:
    t = "pciat_pciat_total"
    nm = f"({_nulls(B.ITEM_COLS)})"
    b0, b1, b2 = B.BINDING_BANDS
    best = f"({t} + {nm} * 5)"
    code = (f"CASE WHEN {t} <= {b0} AND {best} <= {b0} THEN 0 "
            f"WHEN {t} BETWEEN {b0 + 1} AND {b1} AND {best} <= {b1} THEN 1 "
            f"WHEN {t} BETWEEN {b1 + 1} AND {b2} AND {best} <= {b2} THEN 2 "
            f"WHEN {t} >= {b2 + 1} AND {best} >= {b2 + 1} THEN 3 END")
    labels = "[" + ", ".join(f"'{x}'" for x in SII) + "]"
    allp = " AND ".join(f"{c} IS NOT NULL" for c in B.ITEM_COLS)
    return (f"pt AS (SELECT *, CAST({code} AS INTEGER) AS recalc_sii, "
            f"{labels}[CAST({code} AS INTEGER) + 1] AS sii, "
            f"CASE WHEN {allp} THEN {t} END AS complete_resp_total FROM {src})")


def health_cte(src: str = "p") -> str:
    fgc = " + ".join(f"coalesce({c}, 0.0)" for c in
                     ["fgc_fgc_cu", "fgc_fgc_cu_zone", "fgc_fgc_gsnd", "fgc_fgc_gsnd_zone", "fgc_fgc_gsd", "fgc_fgc_gsd_zone"])
    z = lambda c: (f"({c} - (SELECT avg({c}) FROM {src})) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1.0 "  # noqa: E731
                   f"ELSE stddev_pop({c}) END FROM {src})")
    return (f"ph AS (SELECT *, (physical_bmi + physical_waist_circumference + physical_diastolic_bp + physical_systolic_bp) / 4 "
            "AS physical_health_index, fitness_endurance_max_stage + (fitness_endurance_time_mins * 60 + "
            "fitness_endurance_time_sec) AS fitness_endurance_score, "
            f"{z('physical_height')} AS height_norm, {z('physical_weight')} AS weight_norm, "
            f"{sdiv('bia_bia_fat', 'bia_bia_ffm')} AS fat_to_lean_mass_ratio, "
            "preint_eduhx_computerinternet_hoursday * 7 AS computer_engagement, "
            "paq_a_paq_a_total + paq_c_paq_c_total AS cumulative_paq, "
            f"({fgc}) / 6 AS fgc_percentage, CAST(physical_bmi IS NULL OR physical_height IS NULL OR "
            f"physical_weight IS NULL AS INTEGER) AS missing_health_data FROM {src})")


HEALTH = ["physical_health_index", "fitness_endurance_score", "height_norm", "weight_norm", "fat_to_lean_mass_ratio",
          "computer_engagement", "cumulative_paq", "fgc_percentage"]
P_DOUBLES = [n for n, e in B.PARTICIPANT_EXPRS if n not in ("id", "basic_demos_enroll_season", "physical_season",
                                                             "basic_demos_age", "basic_demos_sex")] + B.ITEM_COLS + [
    "pciat_pciat_total"]


def _encode_ctes(src: str, cols, prefix: str = "enc") -> str:
    parts = []
    for c in cols:
        parts.append(
            f"{prefix}_{c} AS (SELECT value, CASE WHEN value = 'Missing' THEN 0 ELSE CAST(row_number() OVER "
            f"(ORDER BY first_o, value) AS INTEGER) END AS code FROM (SELECT coalesce({c}, 'Missing') AS value, "
            f"min(id) AS first_o FROM {src} GROUP BY 1))")
    return ", ".join(parts)


def _encoded_select(src: str, cols, prefix: str = "enc") -> str:
    rep = ", ".join(f"CAST(coalesce({prefix}_{c}.code, 0) AS INTEGER) AS {c}" for c in cols)
    joins = " ".join(f"LEFT JOIN {prefix}_{c} ON coalesce({src}.{c}, 'Missing') = {prefix}_{c}.value" for c in cols)
    return f"SELECT {src}.* REPLACE ({rep}) FROM {src} {joins}"


def participant_queries() -> dict[str, str]:
    from pulsegrid.plans.series import FEATURE_NAMES
    q = {}
    P = f"p AS {B.participants_sql()}"
    q["ordinal_target"] = rnd(f"WITH {P}, {target_cte()} SELECT id, recalc_sii, sii, complete_resp_total FROM pt",
                              ["complete_resp_total"])
    q["health_features"] = rnd(f"WITH {P}, {health_cte()} SELECT id, {', '.join(HEALTH)}, missing_health_data FROM ph",
                               HEALTH)
    sf = series_features_sql()
    sf_body = sf[len("WITH "):]
    main_sel = sf_body[sf_body.rindex("SELECT m.id"):]
    sf_ctes = sf_body[:sf_body.rindex("SELECT m.id")].rstrip()
    mt = (f"WITH {P}, {target_cte()}, {health_cte('pt')}, {sf_ctes}, sf AS ({main_sel}), "
          f"j AS (SELECT ph.*, {', '.join('sf.' + n for n in FEATURE_NAMES)} FROM ph LEFT JOIN sf ON ph.id = sf.id), "
          f"{_encode_ctes('j', SEASONS_B)} {_encoded_select('j', SEASONS_B)}")
    q["model_table"] = rnd(mt, P_DOUBLES + ["complete_resp_total"] + HEALTH + _series_double_cols(FEATURE_NAMES))
    q["encode_per_table"] = (f"WITH {P}, {_encode_ctes('p', SEASONS_B)} SELECT id, {', '.join(SEASONS_B)} "
                             f"FROM ({_encoded_select('p', SEASONS_B)})")
    q["encode_shared"] = (f"WITH {P}, b AS {B.cohort_b_sql()}, {_encode_ctes('p', SEASONS_B)} SELECT id, "
                          f"{', '.join(SEASONS_B)} FROM ({_encoded_select('b', SEASONS_B)})")
    keep = ["id", "basic_demos_enroll_season", "physical_season", "basic_demos_age", "physical_height",
            "physical_weight", "recalc_sii", "sii", "complete_resp_total"]
    q["schema_align"] = rnd(f"WITH {P}, {target_cte()} SELECT {', '.join(keep)} FROM pt",
                            ["physical_height", "physical_weight", "complete_resp_total"])
    mcols = B.PARTICIPANT_COLUMNS
    unions = " UNION ALL ".join(
        f"SELECT '{c}' AS field, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS missing_pct FROM p"
        for c in mcols)
    q["missing_report"] = rnd(
        f"WITH {P}, r AS ({unions}) SELECT field, missing_pct, CASE WHEN missing_pct > 50 THEN 'remove' "
        "WHEN missing_pct > 10 AND missing_pct < 50 THEN 'impute' WHEN missing_pct < 10 THEN 'keep' END AS action FROM r",
        ["missing_pct"])
    wide = ", ".join(f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS {c}" for c in mcols)
    q["missing_report_wide"] = rnd(f"WITH {P} SELECT {wide} FROM p", mcols)
    dom = "(VALUES " + ", ".join(f"('{x}')" for x in SII) + ") dom(sii)"
    q["class_distribution"] = rnd(
        f"WITH {P}, {target_cte()}, c AS (SELECT sii, count(id) AS n FROM pt WHERE sii IS NOT NULL GROUP BY sii), "
        f"g AS (SELECT dom.sii, CAST(coalesce(c.n, 0) AS BIGINT) AS count FROM {dom} LEFT JOIN c ON dom.sii = c.sii) "
        "SELECT sii, count, CAST(count AS DOUBLE) / sum(count) OVER () * 100 AS percentage FROM g", ["percentage"])
    q["distribution_by_age"] = rnd(
        f"WITH {P}, {target_cte()}, c AS (SELECT sii, basic_demos_age, count(id) AS n FROM pt WHERE sii IS NOT NULL "
        "AND basic_demos_age IS NOT NULL GROUP BY 1, 2), a AS (SELECT DISTINCT basic_demos_age FROM pt WHERE "
        "basic_demos_age IS NOT NULL), v AS (SELECT basic_demos_age, CAST(count(id) AS BIGINT) AS variable_count FROM pt "
        f"WHERE basic_demos_age IS NOT NULL GROUP BY 1), g AS (SELECT dom.sii, a.basic_demos_age, "
        f"CAST(coalesce(c.n, 0) AS BIGINT) AS count FROM a, {dom} LEFT JOIN c ON dom.sii = c.sii AND "
        "a.basic_demos_age = c.basic_demos_age) SELECT g.sii, g.basic_demos_age, g.count, "
        f"{sdiv('CAST(g.count AS DOUBLE)', 'sum(g.count) OVER (PARTITION BY g.basic_demos_age)')} * 100 AS percentage, "
        "v.variable_count FROM g LEFT JOIN v ON g.basic_demos_age = v.basic_demos_age", ["percentage"])
    q["target_audit"] = rnd(
        f"WITH {P}, {target_cte()} SELECT recalc_sii, CAST(count(id) AS BIGINT) AS id_count, "
        "min(pciat_pciat_total) AS total_min, max(pciat_pciat_total) AS total_max, avg(pciat_pciat_total) AS total_mean "
        "FROM pt WHERE recalc_sii IS NOT NULL GROUP BY recalc_sii", ["total_min", "total_max", "total_mean"])
    q["age_median_split"] = rnd(
        f"WITH {P}, {target_cte()} SELECT CASE WHEN complete_resp_total IS NOT DISTINCT FROM 0 THEN 'zero' "
        "ELSE 'not_zero' END AS part, round_even(quantile_cont(basic_demos_age, 0.5), 2) AS median FROM pt "
        "WHERE basic_demos_age IS NOT NULL GROUP BY 1", ["median"])
    e = "e AS (SELECT quantile_cont(physical_height, [0.0, 0.25, 0.5, 0.75, 1.0]) AS q FROM pt)"
    bterms = ["CAST(q[1] < physical_height AS INTEGER)"] + [
        f"CAST(q[{i}] < physical_height AND q[{i}] <> q[{i - 1}] AS INTEGER)" for i in range(2, 6)]
    bk = (f"b AS (SELECT pt.*, CASE WHEN physical_height IS NOT NULL THEN greatest(1, {' + '.join(bterms)}) END "
          "AS physical_height_bucket, q FROM pt, e)")
    piv = ", ".join(f"CAST(count(id) FILTER (WHERE sii = '{x}') AS BIGINT) AS n_{i}" for i, x in enumerate(SII))
    q["bucket_report"] = rnd(
        f"WITH {P}, {target_cte()}, {e}, {bk}, m AS (SELECT physical_height_bucket, "
        "any_value(q[physical_height_bucket]) AS physical_height_bucket_lo, "
        "any_value(q[physical_height_bucket + 1]) AS physical_height_bucket_hi, "
        "avg(complete_resp_total) AS target_mean FROM b WHERE physical_height_bucket IS NOT NULL GROUP BY 1), "
        f"c AS (SELECT physical_height_bucket, {piv} FROM b WHERE physical_height_bucket IS NOT NULL GROUP BY 1) "
        "SELECT m.*, " + ", ".join(f"c.n_{i}" for i in range(4)) +
        " FROM m LEFT JOIN c ON m.physical_height_bucket = c.physical_height_bucket",
        ["physical_height_bucket_lo", "physical_height_bucket_hi", "target_mean"])
    h = ("h AS (SELECT CAST(pciat_pciat_total AS DOUBLE) AS x FROM pt WHERE pciat_pciat_total IS NOT NULL), "
         "r AS (SELECT min(x) AS lo, max(x) AS hi FROM h), "
         "hb AS (SELECT CASE WHEN hi = lo THEN 1 ELSE least(20, CAST(floor((x - lo) / ((hi - lo) / 20)) AS INTEGER) + 1) "
         "END AS bin FROM h, r), hc AS (SELECT bin, count(*) AS n FROM hb GROUP BY bin)")
    q["score_histogram"] = rnd(
        f"WITH {P}, {target_cte()}, {h} SELECT CAST(g.bin AS INTEGER) AS bin, lo + (g.bin - 1) * (hi - lo) / 20 AS lo, "
        "lo + g.bin * (hi - lo) / 20 AS hi, CAST(coalesce(hc.n, 0) AS BIGINT) AS count FROM r, "
        "(SELECT CAST(range AS INTEGER) AS bin FROM range(1, 21)) g LEFT JOIN hc ON g.bin = hc.bin", ["lo", "hi"])
    corr = " UNION ALL ".join(f"SELECT '{c}' AS field, corr({c}, complete_resp_total) AS corr FROM pt "
                              "WHERE sii IS NOT NULL" for c in PHYSICAL)
    q["corr_table"] = rnd(f"WITH {P}, {target_cte()}, c AS ({corr}) SELECT field, corr, "
                          "round_even(corr, 2) * 100 + 0.0 AS corr_pct FROM c", ["corr", "corr_pct"])
    q["head_rows"] = rnd(f"WITH {P} SELECT id, basic_demos_age, physical_height, physical_weight FROM p "
                         "ORDER BY id LIMIT 5", ["physical_height", "physical_weight"])
    q["weight_floor_sorted"] = rnd(f"WITH {P} SELECT id, physical_weight FROM p WHERE physical_weight >= 10 "
                                   "ORDER BY physical_weight, id", ["physical_weight"])
    return q


# ----------------------------------------------------------------- metrics
def _scored() -> str:
    rd = lambda s: f"CAST(CASE WHEN {s} < 0.5 THEN 0 WHEN {s} < 1.5 THEN 1 WHEN {s} < 2.5 THEN 2 ELSE 3 END AS INTEGER)"
    return f"s AS (SELECT *, {rd('score')} AS p, {rd('score_b')} AS p_b FROM {B.scored_sql()})"


def metric_queries() -> dict[str, str]:
    q = {}
    S = _scored()
    idx = ("lab AS (SELECT l, dense_rank() OVER (ORDER BY l) - 1 AS ix FROM (SELECT y AS l FROM s WHERE y IS NOT NULL "
           "UNION SELECT p FROM s WHERE p IS NOT NULL)), "
           "ij AS (SELECT CAST(a.ix AS DOUBLE) AS i, CAST(b.ix AS DOUBLE) AS j FROM s JOIN lab a ON s.y = a.l "
           "JOIN lab b ON s.p = b.l)")
    q["qwk"] = rnd(f"WITH {S}, {idx} SELECT 1.0 - " + sdiv(
        "sum((i - j) * (i - j))", "sum(i * i) + sum(j * j) - 2 * sum(i) * sum(j) / CAST(count(*) AS DOUBLE)") +
        " AS qwk, CAST(count(*) AS BIGINT) AS n FROM ij", ["qwk"])
    q["cohen_kappa"] = rnd(
        f"WITH {S}, d AS (SELECT * FROM s WHERE y IS NOT NULL AND p IS NOT NULL), "
        "pe AS (SELECT CAST(sum(a.n * b.n) AS DOUBLE) AS s FROM (SELECT y AS c, count(*) AS n FROM d GROUP BY 1) a "
        "JOIN (SELECT p AS c, count(*) AS n FROM d GROUP BY 1) b ON a.c = b.c) "
        "SELECT 1.0 - (1.0 - avg(CAST(y = p AS DOUBLE))) / (1.0 - max(pe.s) / (CAST(count(*) AS DOUBLE) * count(*))) "
        "AS kappa FROM d, pe", ["kappa"])
    grid = "(SELECT a.range AS y, b.range AS p FROM range(0, 4) a, range(0, 4) b)"
    conf = (f"WITH {S}, c AS (SELECT y, p, count(*) AS n FROM s WHERE y IS NOT NULL AND p IS NOT NULL GROUP BY 1, 2) "
            f"SELECT CAST(g.y AS INTEGER) AS y, CAST(g.p AS INTEGER) AS p, CAST(coalesce(c.n, 0) AS BIGINT) AS count "
            f"FROM {grid} g LEFT JOIN c ON g.y = c.y AND g.p = c.p")
    q["confusion"] = conf
    q["class_report"] = rnd(
        f"WITH cf AS ({conf}), a AS (SELECT y AS cls, sum(count) AS support, sum(count) FILTER (WHERE y = p) AS tp "
        "FROM cf GROUP BY 1), b AS (SELECT p AS cls, sum(count) AS predicted FROM cf GROUP BY 1), "
        "r AS (SELECT a.cls, CAST(a.support AS BIGINT) AS support, "
        f"{sdiv('CAST(tp AS DOUBLE)', 'predicted')} AS precision, {sdiv('CAST(tp AS DOUBLE)', 'support')} AS recall "
        "FROM a JOIN b ON a.cls = b.cls) SELECT cls, support, precision, recall, "
        f"{sdiv('2 * precision * recall', 'precision + recall')} AS f1 FROM r", ["precision", "recall", "f1"])
    q["regression_summary"] = rnd(
        f"WITH {S} SELECT avg(CAST(y = p AS DOUBLE)) AS accuracy, avg(abs(y - p)) AS mae, "
        "CAST(count(*) AS BIGINT) AS n FROM s WHERE y IS NOT NULL AND p IS NOT NULL", ["accuracy", "mae"])
    K = 40
    t = [f"CAST(k{i} AS DOUBLE) * CAST('0.1' AS DOUBLE)" for i in (1, 2, 3)]
    rank = lambda v: "CAST(" + " + ".join(f"s{u} * CAST({v} > {u} AS INTEGER)" for u in range(3)) + " AS DOUBLE)"
    tg = (f"WITH {S}, d AS (SELECT y, score, count(*) AS n FROM s WHERE y IS NOT NULL GROUP BY 1, 2), "
          f"g AS (SELECT range AS k FROM range(0, {K + 1})), "
          "c AS (SELECT a.k AS k1, b.k AS k2, c.k AS k3 FROM g a, g b, g c WHERE a.k < b.k AND b.k < c.k), "
          f"pr AS (SELECT k1, k2, k3, y, CASE WHEN score < {t[0]} THEN 0 WHEN score < {t[1]} THEN 1 "
          f"WHEN score < {t[2]} THEN 2 ELSE 3 END AS p, n FROM c, d), "
          "m AS (SELECT k1, k2, k3, y, p, sum(n) AS n FROM pr GROUP BY ALL), "
          "f AS (SELECT k1, k2, k3, " + ", ".join(f"max(CAST(y = {u} OR p = {u} AS INTEGER)) AS s{u}" for u in range(3)) +
          " FROM m GROUP BY ALL), "
          f"ij AS (SELECT k1, k2, k3, n, {rank('y')} AS i, {rank('p')} AS j FROM m JOIN f USING (k1, k2, k3)), "
          "qq AS (SELECT k1, k2, k3, 1.0 - " + sdiv("sum(n * (i - j) * (i - j))",
                                                    "sum(n * i * i) + sum(n * j * j) - 2 * sum(n * i) * sum(n * j) / sum(n)") +
          " AS qwk FROM ij GROUP BY k1, k2, k3) "
          "SELECT 0.0 + k1 * 0.1 AS t1, 0.0 + k2 * 0.1 AS t2, 0.0 + k3 * 0.1 AS t3, qwk FROM qq "
          "ORDER BY coalesce(qwk, -2.0) DESC, k1, k2, k3 LIMIT 1")
    q["threshold_grid"] = rnd(f"SELECT CAST(t1 AS DOUBLE) AS t1, CAST(t2 AS DOUBLE) AS t2, CAST(t3 AS DOUBLE) AS t3, "
                              f"qwk FROM ({tg})", ["t1", "t2", "t3", "qwk"])
    q["majority_vote"] = (f"WITH {S} SELECT id, p, p_b, CASE WHEN p IS NULL THEN p_b WHEN p_b IS NULL THEN p "
                          "ELSE least(p, p_b) END AS vote, CAST(round_even(score, 0) AS INTEGER) AS rounded FROM s")
    q["submission_vote"] = (f"WITH {S} SELECT id, p AS sii_0, p_b AS sii_1, CASE WHEN p IS NULL THEN p_b WHEN p_b IS NULL THEN p "
                            "ELSE least(p, p_b) END AS sii FROM s")
    q["stratified_folds"] = (
        f"WITH {S}, c AS (SELECT y, count(*) AS n FROM s WHERE y IS NOT NULL GROUP BY y), "
        "f AS (SELECT CAST(range AS INTEGER) AS fold FROM range(0, 5)) "
        "SELECT y, fold, CAST((n - 1 - fold) // 5 + 1 AS BIGINT) AS n FROM c, f WHERE fold <= n - 1")
    q["fold_assignment"] = (
        f"WITH {S}, h AS (SELECT id, y, CAST('0x' || substr(md5(CAST(id AS VARCHAR) || '/42'), 1, 15) AS BIGINT) AS h "
        "FROM s WHERE y IS NOT NULL) SELECT id, y, CAST((row_number() OVER (PARTITION BY y ORDER BY h, id) - 1) % 5 AS INTEGER) AS fold FROM h")
    return q


def io_queries() -> dict[str, str]:
    return {"series_store": rnd(
        f"SELECT id, count(*) AS n_rows, min(step) AS first_step, max(step) AS last_step, sum(enmo) AS enmo, count(*) AS n_listed, "
        f"sum(light) AS light FROM {B.series_sql()} GROUP BY id", ["enmo", "light"])}


def all_sql() -> dict[str, str]:
    return {**io_queries(), **series_queries(), **participant_queries(), **metric_queries()}
