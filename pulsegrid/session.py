"""Session construction and cluster-facing settings.

The library never hard-codes a storage location: lineage cuts go to the
folder named by ``spark.checkpoint.dir``. A cluster session must name one;
only a local session without it (tests) uses a private scratch folder.
"""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that matter at scale. AQE re-plans joins from runtime sizes
# (broadcast only when the measured side is small), splits skewed
# partitions of sort-merge joins, and coalesces tiny shuffle partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the per-id feature aggregate carries ~250 buffer fields; keep it in
    # whole-stage codegen instead of the slower non-codegen path (limit 100)
    "spark.sql.codegen.maxFields": "1000",
}


def build_session(master: str = "local[8]", shuffle_partitions: int | None = None,
                  app_name: str = "pulsegrid", extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests (UI off, AQE on)."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "8g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder (``spark.checkpoint.dir``). Only a
    local[*] session without the setting gets a private scratch folder."""
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="pulsegrid-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found


def ship_package(spark: SparkSession) -> None:
    """Give Python workers on executors this package (once a context), as
    ``--py-files`` would."""
    sc, top = spark.sparkContext, Path(__file__).resolve().parent
    if not getattr(sc, "_package_shipped", False) and top.is_dir():
        sc.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp(prefix='code-')}/{top.name}", "zip", top.parent, top.name))
        sc._package_shipped = True
