"""Run registered Spark queries and their DuckDB oracle side by side.

Usage: python tools/compare.py [sf_dir] [key ...]
Prints per key: rows (spark/duck), column match, value match.
"""

from __future__ import annotations

import math
import sys
import time

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

import duckdb  # noqa: E402

from pulsegrid.catalog import QUERIES  # noqa: E402
from pulsegrid.oracle import all_sql  # noqa: E402
from pulsegrid.session import build_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 5)
    if hasattr(v, "isoformat"):
        return str(v)
    return v


def key(row):
    return tuple((0, "") if x is None else (1, str(x)) for x in row)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    sqls = all_sql()
    import os
    if os.environ.get("PLAIN"):
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
                 .config("spark.ui.enabled", "false").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = build_session()
    ok = 0
    for k, fn in QUERIES.items():
        if only and k not in only:
            continue
        if k not in sqls:
            print(f"{k:24s} (no oracle)")
            continue
        t = time.time()
        try:
            sdf = fn(spark, sf)
            scols = sorted(sdf.columns)
            srows = [tuple(norm(r[c]) for c in scols) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{k:24s} SPARK FAIL {str(e)[:300]}")
            continue
        ts = time.time() - t
        try:
            rel = con.sql(sqls[k])
            dcols = rel.columns
            drows_raw = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{k:24s} DUCK FAIL {str(e)[:400]}")
            continue
        order = sorted(range(len(dcols)), key=lambda i: dcols[i])
        drows = [tuple(norm(r[i]) for i in order) for r in drows_raw]
        colmatch = scols == sorted(dcols)
        same = sorted(srows, key=key) == sorted(drows, key=key)
        ok += colmatch and same
        print(f"{k:24s} rows {len(srows):6d}/{len(drows):6d} cols {'ok' if colmatch else 'DIFF'} "
              f"values {'ok' if same else 'DIFF'} {ts:6.2f}s", flush=True)
        if not colmatch:
            print("   spark-only", sorted(set(scols) - set(dcols)), "duck-only", sorted(set(dcols) - set(scols)))
        elif not same:
            sd = sorted(set(srows) - set(drows), key=key)[:3]
            dd = sorted(set(drows) - set(srows), key=key)[:3]
            print("   cols", scols)
            print("   spark", sd)
            print("   duck ", dd)
    print("matched", ok)


if __name__ == "__main__":
    main()
