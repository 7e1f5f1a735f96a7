"""Benchmark: run every registered query on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (no collect to the
driver): one untimed warm-up run (JIT, code generation, file listing), then
$BENCH_RUNS timed runs; the per-query figure is the median of the timed runs.
Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dimforge.plans import load_all  # noqa: E402
from dimforge.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus,
                          app="dimforge-bench")
    reg = load_all()
    keys = only or sorted(reg)
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    times: dict[str, float] = {}
    cold: dict[str, float] = {}

    def run(k: str) -> float:
        t0 = time.perf_counter()
        reg[k][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    errors: dict[str, str] = {}
    for k in keys:
        try:
            cold[k] = round(run(k), 3)
            times[k] = round(statistics.median(run(k) for _ in range(runs)), 3)
        except Exception as e:  # noqa: BLE001 - one failing query must not hide the others' timings
            errors[k] = f"{type(e).__name__}: {str(e)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus,
                      "n_queries": len(times), "timed_runs": runs, "statistic": "median_warm",
                      "cold_total_sec": round(sum(cold.values()), 3), "errors": errors}))
    spark.stop()


if __name__ == "__main__":
    main()
