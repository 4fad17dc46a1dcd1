"""Print the at-scale plan shape of registered queries: the static physical
plan with broadcasts disabled and AQE off (what a large cluster would run
before runtime re-planning), reduced to its exchanges, windows and joins.

Usage: python tools/plan_digest.py [sf_dir] [key ...]
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from pulsegrid.catalog import QUERIES  # noqa: E402
from pulsegrid.session import build_session  # noqa: E402

KEEP = ("Exchange", "Window [", "SortMergeJoin", "BroadcastHashJoin", "FileScan", "Expand", "Generate")


def digest(plan: str) -> list[str]:
    out = []
    for line in plan.split("\n"):
        if any(k in line for k in KEEP):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r"\[plan_id=\d+\]", "", line)
            line = re.sub(r"specifiedwindowframe\([^)]*\)\)?", "", line)
            line = re.sub(r"Location: [^,]*, ", "", line)
            if "FileScan" in line:
                m = re.search(r"(FileScan \w+) \[([^\]]*)\].*?(PushedFilters: \[[^\]]*\]).*?(ReadSchema: \S+)", line)
                if m:
                    line = line[:line.index("FileScan")] + f"{m.group(1)} {m.group(3)} {m.group(4)}"
            out.append(line.rstrip()[:200])
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or ["series_features", "model_table", "stratified_folds", "bucket_report"]
    spark = build_session(extra={"spark.sql.autoBroadcastJoinThreshold": "-1",
                                 "spark.sql.adaptive.enabled": "false"})
    for k in keys:
        plan = QUERIES[k](spark, sf)._jdf.queryExecution().executedPlan().toString()
        lines = digest(plan)
        n_ex = sum("Exchange" in x for x in lines)
        print(f"## {k}\n\n{n_ex} exchanges (static plan, no broadcast)\n\n```")
        print("\n".join(lines))
        print("```\n")


if __name__ == "__main__":
    main()
