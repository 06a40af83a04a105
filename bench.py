"""Bench: the KPI refresh at $BENCH_SF_DIR on local[$BENCH_CPUS].

Default (``BENCH_MODE=pipeline``), the production shape of a refresh:
  1. ``materialize``: derive the eight source tables from the driver's
     tables and write them, plus the two order-grain marts, as parquet into
     a fresh folder under the checkpoint dir (one timed step);
  2. every registered KPI/view query over those tables, each fully evaluated
     through the ``noop`` sink (all rows computed, nothing collected).
``BENCH_MODE=cold`` instead times every registered query on its own from
the raw driver tables (what the correctness gate runs).

Prints ONE JSON line:
{"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
BENCH_QUERIES (comma separated) limits the run to some queries.
"""
from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _calibration() -> float:
    """Seconds of a fixed loop on one core: divide by it to compare runs of different machines."""
    t0 = time.perf_counter()
    x = 0
    for i in range(10_000_000):
        x = (x * 31 + i) & 0xFFFFFFFF
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    before = _calibration()
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    mode = os.environ.get("BENCH_MODE", "pipeline")
    from cargoline.plans.registry import MODEL_QUERIES, queries
    from cargoline.session import local_session
    from cargoline.sources.adapter import from_tpch

    n_cpus = int(cpus) if cpus.isdigit() else os.cpu_count() or 8
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * n_cpus), app="cargoline-bench")
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    # warm the JVM (class loading, codegen cache) on a small query
    _noop(queries()["suppliers"](spark, sf_dir))

    times: dict[str, float] = {}
    if mode == "cold":
        qs = queries()
        for name in wanted or list(qs):
            t0 = time.perf_counter()
            _noop(qs[name](spark, sf_dir))
            times[name] = round(time.perf_counter() - t0, 3)
    else:
        from cargoline.plans.materialize import MaterializedModel

        t0 = time.perf_counter()
        model = MaterializedModel(spark, from_tpch(spark, sf_dir))
        times["materialize"] = round(time.perf_counter() - t0, 3)
        for name in wanted or MODEL_QUERIES:
            t0 = time.perf_counter()
            out = getattr(model, name)
            _noop(out() if callable(out) else out)
            times[name] = round(time.perf_counter() - t0, 3)
    spark.stop()

    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({
        "metric": "total_query_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "mode": mode,
        "cpus": cpus,
        "calibration_sec": [before, _calibration()],
    }))


if __name__ == "__main__":
    main()
