"""Partitioned series store round trip, lineage scan, CSV sink."""

import tempfile

from core_paths import SF
from pyspark.sql import functions as F

from pulsegrid.plans import bindings
from pulsegrid.plans import series as S
from pulsegrid.sources.io import read_csv, read_series, read_with_lineage, write_csv, write_parquet


def _store(spark, root):
    ser = bindings.series(spark, SF).withColumn("id", F.format_string("%08x", F.col("id")))
    write_parquet(ser, f"{root}/series", partition_by="id")
    return ser


def test_partitioned_store_round_trip(spark):
    root = tempfile.mkdtemp(prefix="pg-io-", dir="/tmp")
    ser = _store(spark, root)
    back = read_series(spark, f"{root}/series")
    assert dict(back.dtypes)["id"] == "string"
    assert back.count() == ser.count()
    assert back.where(F.col("id") == "00000003").count() == ser.where(F.col("id") == "00000003").count()
    a = S.series_features(ser).orderBy("id").collect()
    b = S.series_features(back.select(*ser.columns)).orderBy("id").collect()
    assert [r["id"] for r in a] == [r["id"] for r in b]
    lin = read_with_lineage(spark, f"{root}/series")
    assert lin.where(F.col("file_name").contains("id=")).count() == ser.count()
    write_csv(S.stat_aliases(S.series_features(back.select(*ser.columns))), f"{root}/ts_csv")
    df, names = read_csv(spark, f"{root}/ts_csv")
    assert df.count() == len(a) and "stat_57" in df.columns


def test_wear_filter_and_pruning_reach_the_scan(spark):
    """On a store with a real flag column, the wear filter is pushed into the
    Parquet reader, only the needed columns are read, and an id filter
    prunes partition directories."""
    root = tempfile.mkdtemp(prefix="pg-pd-", dir="/tmp")
    _store(spark, root)
    back = read_series(spark, f"{root}/series")
    plan = S.daypart_activity(back.where(F.col("id") == "00000003"))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(non_wear_flag,0)" in plan, plan
    read_schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    for unused in ("battery_voltage", "anglez", "light", "relative_date"):
        assert unused not in read_schema, read_schema
    assert "PartitionFilters: [isnotnull(id" in plan and "= 00000003" in plan


def test_read_participants_types_by_name(spark):
    import pandas as pd
    from pyspark.sql import types as T

    from pulsegrid.sources.io import read_participants, write_csv
    root = tempfile.mkdtemp(prefix="pg-csv-", dir="/tmp")
    pd.DataFrame({
        "id": ["00aa11bb", "00cc22dd"], "Basic_Demos-Enroll_Season": ["Fall", None],
        "Basic_Demos-Age": ["10", "12.0"], "Physical-BMI": ["16.5", None], "PCIAT-PCIAT_01": ["3", "5"],
        "sii": ["1", None],
    }).to_csv(f"{root}/p.csv", index=False)
    df, names = read_participants(spark, f"{root}/p.csv")
    t = dict((f.name, f.dataType) for f in df.schema.fields)
    assert t["id"] == T.StringType() and t["basic_demos_enroll_season"] == T.StringType()
    assert t["basic_demos_age"] == T.IntegerType() and t["sii"] == T.IntegerType()
    assert t["physical_bmi"] == T.DoubleType() and t["pciat_pciat_01"] == T.DoubleType()
    rows = {r["id"]: r for r in df.collect()}
    assert rows["00cc22dd"]["basic_demos_age"] == 12 and rows["00cc22dd"]["physical_bmi"] is None
    assert names["basic_demos_enroll_season"] == "Basic_Demos-Enroll_Season"
    write_csv(df, f"{root}/out", names)
    back = spark.read.option("header", True).csv(f"{root}/out")
    assert "Basic_Demos-Enroll_Season" in back.columns and back.count() == 2


def test_series_store_with_source_names(spark, tmp_path):
    """Hyphenated names, the dated offset column, NaN and text time of day."""
    from pulsegrid.plans import series as S
    from pulsegrid.sources.io import read_series
    ns = 3_600_000_000_000
    rows = [("00a1", i, 1.0, 0.5, float("nan") if i == 3 else 0.1, 0.2, 10.0, 0.0, float("nan") if i % 4 == 0 else 30.0, 4100.0 - i,
             f"{6 + i % 12:02d}:30:15.000000250", 1 + i % 7, 2, 10.0 + i // 8) for i in range(40)]
    names = ["id", "step", "X", "Y", "Z", "enmo", "anglez", "non-wear_flag", "light", "battery_voltage", "time_of_day", "weekday", "quarter", "relative_date_PCIAT"]
    text = spark.createDataFrame(rows, names)
    text.write.partitionBy("id").parquet(str(tmp_path / "text"))
    as_ns = text.withColumn("time_of_day", ((F.substring("time_of_day", 1, 2).cast("long") * 3600 + 30 * 60 + 15) * 1_000_000_000 + 250).cast("long"))
    as_ns.write.partitionBy("id").parquet(str(tmp_path / "ns"))
    a, b = read_series(spark, str(tmp_path / "text")), read_series(spark, str(tmp_path / "ns"))
    assert set(a.columns) == {f.name for f in S.SERIES_SCHEMA}
    got = a.orderBy("step").collect()
    assert got[0]["time_of_day"] == 6 * ns + 1815 * 1_000_000_000 + 250 and got[0]["light"] is None and got[3]["z"] is None
    assert a.select(sorted(a.columns)).exceptAll(b.select(sorted(b.columns))).count() == 0
    f = S.series_features(a).collect()
    assert len(f) == 1 and f[0]["id"] == "00a1"
    assert all(v is None or v == v for v in f[0])  # no NaN


def test_store_writes_one_file_a_key_and_lists_with_few_tasks(spark, tmp_path):
    """No checksum file beside each file (a process or two per file on local
    storage), many folders in few listing tasks, settings as before after it."""
    root, keys = str(tmp_path / "s"), 300  # more folders than LISTING_TASKS
    names = ["spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.sources.partitionColumnTypeInference.enabled"]
    before = [spark.conf.get(n) for n in names]
    write_parquet(spark.range(2 * keys).select(F.col("id").alias("v"), F.format_string("%03d", F.col("id") % keys).alias("id")), root, partition_by="id")
    files = [f for f in (tmp_path / "s").rglob("*") if f.is_file()]
    assert len([f for f in files if f.name.startswith("part-")]) == keys and not [f for f in files if f.name.endswith(".crc")]
    tracker = spark.sparkContext.statusTracker()
    for read in (read_series, read_with_lineage):
        spark.sparkContext.setJobGroup(f"listing-{read.__name__}", "")
        df = read(spark, root)
        tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup(f"listing-{read.__name__}") for s in tracker.getJobInfo(j).stageIds]
        spark.sparkContext._jsc.clearJobGroup()
        assert 1 < max(tasks) <= 256
        assert sorted((r["id"], r["v"]) for r in df.select("id", "v").collect()) == sorted((f"{i % keys:03d}", i) for i in range(2 * keys))
    assert [spark.conf.get(n) for n in names] == before
