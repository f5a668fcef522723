"""Summarize the physical plan of registered queries: scans, exchanges, joins, single-task steps, Python steps.

usage: python tools/plans.py [sf_dir] [name ...]
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from custodia.catalog import ENTRIES  # noqa: E402
from custodia.session import build_session  # noqa: E402

STEPS = {
    "scan": r"(?:Scan|FileScan) parquet",
    "shuffle": r"Exchange (?:hash|range)partitioning",
    "rebalance": r"REBALANCE",
    "single": r"Exchange SinglePartition",
    "smj": r"SortMergeJoin",
    "shj": r"ShuffledHashJoin",
    "bhj": r"BroadcastHashJoin",
    "bnlj": r"BroadcastNestedLoopJoin",
    "cartesian": r"CartesianProduct",
    "window": r"\bWindow \[",
    "python": r"(?:Arrow|Batch)EvalPython|InPandas",
}


def main():
    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.001"
    wanted = set(args[1:])
    # without broadcasts the plans look as they do on large tables
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__sql__autoBroadcastJoinThreshold="-1"
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name, (fn, _) in ENTRIES.items():
        if wanted and name not in wanted:
            continue
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        found = {k: len(re.findall(p, plan)) for k, p in STEPS.items()}
        print(f"{name:26s}", " ".join(f"{k}={n}" for k, n in found.items() if n), flush=True)


if __name__ == "__main__":
    main()
