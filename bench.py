"""Times the headline queries and prints one JSON line.

Settings: ``BENCH_SF_DIR`` (table folder), ``BENCH_CPUS`` (local cores), ``BENCH_RUNS`` (timed runs per query, the
best counts). A first query at the same scale warms the session and is not counted.
"""

from __future__ import annotations

import json
import os
import re
import time

from gridtide.session import build_session
from workload.registry import queries

HEADLINE = [
    "q_trailing_avg",
    "q_stage_demand",
    "q_stage_weather",
    "q_stage_generation",
    "q_stage_sales",
    "q_isd_parse",
    "q_fact_demand",
    "q_fact_weather",
    "q_fact_generation",
    "q_fact_sales",
    "q_generation_mix",
    "q_weather_demand_correlation",
    "q_peak_drivers",
    "q_cumulative_patterns",
    "q_state_changes",
    "q_percent_rank",
    "q_line_price_rank",
    "q_group_percentiles",
    "q_incremental_demand",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        f"local[{cpus}]",
        app="bench",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run(HEADLINE[0])
    times = {name: round(min(run(name) for _ in range(runs)), 3) for name in HEADLINE}
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
