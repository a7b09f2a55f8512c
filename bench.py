"""Benchmark the headline reports; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_REPEAT (default 3, best-of; the first
run of a plan includes JVM code generation and JIT warm-up). Each query is planned and
executed to completion with the ``noop`` sink (no driver collect); the
time per query includes planning.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dialtone.catalog.queries import queries  # noqa: E402
from dialtone.session import build_session  # noqa: E402

HEADLINE = [
    "hourly_call_summary",          # R1
    "hourly_call_summary_w_hour",   # R2
    "agent_productivity",           # R3
    "agent_productivity_all",       # R4
    "agent_productivity_bu",        # R5
    "agent_events_all",             # R6
    "agent_events_bu",              # R7
    "call_performance",             # R8
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(f"local[{cpus}]", app_name="dialtone-bench",
                          shuffle_partitions=max(cpus, 1),
                          extra_conf={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    qs = queries()
    # warm-up: JVM, class loading, parquet footers
    qs["call_performance"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    def best_of(build) -> float:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        return round(best, 3)

    times = {name: best_of(lambda n=name: qs[n](spark, sf_dir)) for name in HEADLINE}
    planning = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir)._jdf.queryExecution().executedPlan()
        planning[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_report_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "planning_only": planning}))
    spark.stop()


if __name__ == "__main__":
    main()
