"""Summarise the final (adaptive) physical plan of every query.

Usage: python tests/plan_report.py [sf_dir] [--broadcast]
Runs each query once over materialised sources (the refresh's shape) and
prints: file scans, shuffle exchanges, reused exchanges, join strategies, aggregate
operators, windows and the widest window partition keys.  Without
``--broadcast`` the planner's static broadcast is disabled (at 100 TB every
input table is far above any threshold) while AQE's runtime size check stays
at 10 MB: a side broadcasts only when its measured size is small -- the plan a
100 TB input gets.
"""
from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(argv):
    sf_dir = next((a for a in argv if os.path.isdir(a)), "/root/testdata/sf0.01")
    from cargoline.plans.materialize import MaterializedModel
    from cargoline.plans.registry import MODEL_QUERIES
    from cargoline.session import local_session
    from cargoline.sources.adapter import from_tpch

    spark = local_session(shuffle_partitions=16)
    if "--broadcast" not in argv:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    model = MaterializedModel(spark, from_tpch(spark, sf_dir))
    print(f"{'query':38} {'scans':>5} {'shuffles':>8} {'reused':>6} {'SMJ':>4} {'BHJ':>4} {'BNLJ':>4} {'hashAgg':>7} "
          f"{'objAgg':>6} {'sortAgg':>7} {'window':>6}")
    for name in MODEL_QUERIES:
        out = getattr(model, name)
        df = out() if callable(out) else out
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        shuffles = len(re.findall(r"(?<!Reused)Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))
        scans = len(re.findall(r"FileScan|Scan parquet", plan))
        print(f"{name:38} {scans:5d} {shuffles:8d} {plan.count('ReusedExchange'):6d} {plan.count('SortMergeJoin'):4d} "
              f"{plan.count('BroadcastHashJoin'):4d} {plan.count('BroadcastNestedLoopJoin'):4d} "
              f"{plan.count('HashAggregate('):7d} {plan.count('ObjectHashAggregate('):6d} "
              f"{plan.count('SortAggregate('):7d} {plan.count('Window ['):6d}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
