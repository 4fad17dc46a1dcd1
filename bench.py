"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each query is fully executed with the no-op sink (no driver collect).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pulsegrid.catalog import QUERIES  # noqa: E402
from pulsegrid.session import build_session  # noqa: E402

HEADLINE = [
    "series_features", "model_table", "daypart_activity", "movement_entropy", "ordered_movement",
    "wear_streak_raw", "series_describe", "distance_by_grain", "health_features", "encode_per_table",
    "missing_report", "distribution_by_age", "bucket_report", "corr_table", "qwk", "threshold_grid",
    "stratified_folds",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    # warm the JVM (class loading, codegen caches) on a cheap query
    QUERIES["qwk"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for k in keys:
        t = time.time()
        QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[k] = round(time.time() - t, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
