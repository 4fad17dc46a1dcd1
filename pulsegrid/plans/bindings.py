"""Views that carry the library's operators onto the driver's tables.

The driver ships TPC-H-like tables plus ``events``; the operators are about
wrist-sensor series and participant questionnaires. Each view below is a
plain projection whose column expressions are written once, as SQL text
that both Spark (``selectExpr``) and DuckDB accept, so the oracle queries
read exactly the same derived data. Every view reads the whole table.

* ``series``        <- events (one row per event = one 5 s sensor step)
* ``participants``  <- customer + per-priority order maxima (questionnaire items)
* ``scored``        <- labels + documents (true class, model score)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------- series
# Column expressions over `events` (stage 1), then derived columns (stage 2).
SERIES_STAGE1 = [
    ("id", "user_id"),
    ("step", "event_id"),
    ("x", "value / 100"),
    ("light", "CAST(get_json_object(props, '$.k') AS DOUBLE)"),
    ("z", "CAST(event_id % 201 - 100 AS DOUBLE) / 100"),
    ("anglez", "CAST((event_id * 37) % 181 - 90 AS DOUBLE)"),
    ("non_wear_flag", "CASE WHEN event_type = 'error' THEN 1 ELSE 0 END"),
    ("battery_voltage", "4200.0 - CAST(event_id AS DOUBLE) / 50 - CAST(event_id % 7 AS DOUBLE)"),
    ("time_of_day", "((CAST(hour(ts) AS BIGINT) * 3600 + minute(ts) * 60) * 1000000 + CAST(EXTRACT(SECOND FROM ts) * 1000000 AS BIGINT)) * 1000"),
    ("relative_date", "CAST(datediff(CAST(ts AS DATE), DATE '2024-01-15') AS INT)"),
    ("weekday", "CAST(weekday(ts) + 1 AS INT)"),
    ("quarter", "CAST(quarter(ts) AS INT)"),
]
SERIES_STAGE2 = [
    ("y", "light / 100"),
    ("enmo", "greatest(sqrt(x * x + (light / 100) * (light / 100) + z * z) - 1, 0.0)"),
]
SERIES_COLUMNS = ["id", "step", "x", "y", "z", "enmo", "anglez", "non_wear_flag", "light",
                  "battery_voltage", "time_of_day", "weekday", "quarter", "relative_date"]

# Spark-only function names mapped to DuckDB spellings.
_DUCK = [
    ("get_json_object(props, '$.k')", "json_extract_string(props, '$.k')"),
    ("CAST(EXTRACT(SECOND FROM ts) * 1000000 AS BIGINT)", "microsecond(ts)"),
    ("datediff(CAST(ts AS DATE), DATE '2024-01-15')", "date_diff('day', DATE '2024-01-15', CAST(ts AS DATE))"),
    ("weekday(ts) + 1", "isodow(ts)"),
]


def _duck(expr: str) -> str:
    for a, b in _DUCK:
        expr = expr.replace(a, b)
    return expr


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    s1 = ev.selectExpr(*[f"{e} AS {n}" for n, e in SERIES_STAGE1])
    return s1.selectExpr("*", *[f"{e} AS {n}" for n, e in SERIES_STAGE2]).select(*SERIES_COLUMNS)


def series_sql() -> str:
    s1 = ", ".join(f"{_duck(e)} AS {n}" for n, e in SERIES_STAGE1)
    s2 = ", ".join(f"{e} AS {n}" for n, e in SERIES_STAGE2)
    cols = ", ".join(SERIES_COLUMNS)
    return f"(SELECT {cols} FROM (SELECT *, {s2} FROM (SELECT {s1} FROM events) s1) s2)"


# ---------------------------------------------------------- participants
# Questionnaire item i is the customer's largest order price
# (in 100,000s, capped at 5) for order priority i; bands of the 0..25 total.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
ITEM_COLS = [f"pciat_pciat_{i + 1:02d}" for i in range(len(PRIORITIES))]
ITEM_MAX = 5
BINDING_BANDS = (9, 12, 15)
SEASONS = ["Spring", "Summer", "Fall", "Winter"]

PARTICIPANT_EXPRS = [
    ("id", "c_custkey"),
    ("basic_demos_enroll_season", "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END"),
    ("physical_season", "CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_nationkey % 4 = 0 THEN 'Spring' "
                        "WHEN c_nationkey % 4 = 1 THEN 'Summer' WHEN c_nationkey % 4 = 2 THEN 'Fall' ELSE 'Winter' END"),
    ("basic_demos_age", "CAST(5 + c_custkey % 18 AS INT)"),
    ("basic_demos_sex", "CAST(c_custkey % 2 AS INT)"),
    ("cgas_cgas_score", "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(40 + c_custkey % 60 AS DOUBLE) END"),
    ("physical_bmi", "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE 12 + CAST(c_custkey * 7 % 200 AS DOUBLE) / 10 END"),
    ("physical_height", "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 40 + CAST(c_custkey * 13 % 400 AS DOUBLE) / 10 END"),
    ("physical_weight", "10 + c_acctbal / 100"),
    ("physical_waist_circumference", "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(20 + c_custkey % 15 AS DOUBLE) END"),
    ("physical_diastolic_bp", "CAST(60 + c_custkey % 30 AS DOUBLE)"),
    ("physical_heartrate", "CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(60 + c_custkey % 50 AS DOUBLE) END"),
    ("physical_systolic_bp", "CAST(100 + c_custkey % 40 AS DOUBLE)"),
    ("fitness_endurance_max_stage", "CASE WHEN c_custkey % 3 = 1 THEN NULL ELSE CAST(c_custkey % 10 AS DOUBLE) END"),
    ("fitness_endurance_time_mins", "CASE WHEN c_custkey % 3 = 1 THEN NULL ELSE CAST(c_custkey % 7 AS DOUBLE) END"),
    ("fitness_endurance_time_sec", "CASE WHEN c_custkey % 3 = 1 THEN NULL ELSE CAST(c_custkey % 60 AS DOUBLE) END"),
    ("fgc_fgc_cu", "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE CAST(c_custkey % 25 AS DOUBLE) END"),
    ("fgc_fgc_cu_zone", "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE CAST(c_custkey % 2 AS DOUBLE) END"),
    ("fgc_fgc_gsnd", "CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE CAST(10 + c_custkey % 20 AS DOUBLE) END"),
    ("fgc_fgc_gsnd_zone", "CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE CAST(1 + c_custkey % 3 AS DOUBLE) END"),
    ("fgc_fgc_gsd", "CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST(12 + c_custkey % 18 AS DOUBLE) END"),
    ("fgc_fgc_gsd_zone", "CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST(1 + c_custkey % 3 AS DOUBLE) END"),
    ("bia_bia_fat", "CASE WHEN c_custkey % 5 = 2 THEN NULL ELSE CAST(5 + c_custkey % 20 AS DOUBLE) END"),
    ("bia_bia_ffm", "CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(30 + c_custkey % 25 AS DOUBLE) END"),
    ("paq_a_paq_a_total", "CASE WHEN c_custkey % 4 = 0 THEN CAST(1 + c_custkey % 4 AS DOUBLE) ELSE NULL END"),
    ("paq_c_paq_c_total", "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(1 + c_custkey % 5 AS DOUBLE) / 2 END"),
    ("preint_eduhx_computerinternet_hoursday", "CASE WHEN c_custkey % 6 = 5 THEN NULL ELSE CAST(c_custkey % 4 AS DOUBLE) END"),
]
PARTICIPANT_COLUMNS = [n for n, _ in PARTICIPANT_EXPRS] + ITEM_COLS + ["pciat_pciat_total"]
TOTAL_NULL_MOD = 17


def _item_sql(i: int, p: str) -> str:
    return f"least({ITEM_MAX}, floor(max(CASE WHEN o_orderpriority = '{p}' THEN o_totalprice END) / 100000))"


def participants(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = spark.read.parquet(f"{sf_dir}/customer.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", "o_orderpriority", "o_totalprice")
    # pivot with explicit values: one pass, no value-discovery job
    items = (orders.groupBy("o_custkey").pivot("o_orderpriority", PRIORITIES).agg(F.max("o_totalprice"))
             .select(F.col("o_custkey"), *[F.least(F.lit(float(ITEM_MAX)), F.floor(F.col(f"`{p}`") / 100000).cast("double"))
                                           .alias(c) for p, c in zip(PRIORITIES, ITEM_COLS)]))
    base = cust.selectExpr(*[f"{e} AS {n}" for n, e in PARTICIPANT_EXPRS])
    joined = base.join(items, base["id"] == items["o_custkey"], "left").drop("o_custkey")
    total = F.when(F.col("id") % TOTAL_NULL_MOD == 0, F.lit(None).cast("double")).otherwise(
        sum(F.coalesce(F.col(c), F.lit(0.0)) for c in ITEM_COLS))
    return joined.withColumn("pciat_pciat_total", total).select(*PARTICIPANT_COLUMNS)


def participants_sql() -> str:
    items = ", ".join(f"CAST({_item_sql(i, p)} AS DOUBLE) AS {c}" for i, (p, c) in enumerate(zip(PRIORITIES, ITEM_COLS)))
    base = ", ".join(f"{e} AS {n}" for n, e in PARTICIPANT_EXPRS)
    tot = " + ".join(f"coalesce({c}, 0.0)" for c in ITEM_COLS)
    cols = ", ".join(PARTICIPANT_COLUMNS)
    return (f"(SELECT {cols} FROM (SELECT b.*, {', '.join('i.' + c for c in ITEM_COLS)}, "
            f"CASE WHEN b.id % {TOTAL_NULL_MOD} = 0 THEN NULL ELSE {tot.replace('coalesce(', 'coalesce(i.')} END AS pciat_pciat_total "
            f"FROM (SELECT {base} FROM customer) b LEFT JOIN "
            f"(SELECT o_custkey, {items} FROM orders GROUP BY o_custkey) i ON b.id = i.o_custkey) p)")


# ---------------------------------------------------------------- scored
# true class y = quality + 2 * toxic (0..3); score in [0, 4) from the text length.
SCORED_EXPRS = [
    ("id", "l.doc_id"),
    ("y", "CAST(l.quality + 2 * l.toxic AS INT)"),
    ("score", "CAST(d.n_chars % 400 AS DOUBLE) / 100"),
    ("score_b", "CAST((d.n_chars * 7 + l.doc_id) % 400 AS DOUBLE) / 100"),
]


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = spark.read.parquet(f"{sf_dir}/labels.parquet").alias("l")
    doc = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "n_chars").alias("d")
    return lab.join(doc, F.col("l.doc_id") == F.col("d.doc_id")).selectExpr(*[f"{e} AS {n}" for n, e in SCORED_EXPRS])


def scored_sql() -> str:
    cols = ", ".join(f"{e} AS {n}" for n, e in SCORED_EXPRS)
    return f"(SELECT {cols} FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"


# ------------------------------------------------------- second cohort
# A second participant table (from `supplier`) with fewer columns and its
# own category values: the "test" side for alignment and shared encoding.
COHORT_B_EXPRS = [
    ("id", "s_suppkey"),
    ("basic_demos_enroll_season", "CASE WHEN s_suppkey % 6 = 0 THEN NULL WHEN s_nationkey % 3 = 0 THEN 'BUILDING' "
                                  "WHEN s_nationkey % 3 = 1 THEN 'MACHINERY' ELSE 'RETAIL' END"),
    ("physical_season", "CASE WHEN s_suppkey % 4 = 0 THEN NULL WHEN s_nationkey % 2 = 0 THEN 'Winter' ELSE 'Summer' END"),
    ("basic_demos_age", "CAST(5 + s_suppkey % 18 AS INT)"),
    ("physical_height", "CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE 40 + CAST(s_suppkey * 13 % 400 AS DOUBLE) / 10 END"),
    ("physical_weight", "60 + s_acctbal / 100"),
]


def cohort_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").selectExpr(*[f"{e} AS {n}" for n, e in COHORT_B_EXPRS])


def cohort_b_sql() -> str:
    return "(SELECT " + ", ".join(f"{e} AS {n}" for n, e in COHORT_B_EXPRS) + " FROM supplier)"
