"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3, median reported after one warm-up).
Each query runs to completion through the ``noop`` sink: the whole plan
executes, nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from keyweave.plans import catalog  # noqa: E402
from keyweave.session import local_session  # noqa: E402

HEADLINE = ["join_settled", "join_eager", "emp_table", "emp_table_settled", "join_matched",
            "emp_lookup", "join_hot_key"]


def run(df) -> float:
    t = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=max(cpus, 8))
    # a query of fixed plan: its time tells one machine, or one state of it, from another
    fixed = spark.range(0, 40_000_000, 1, cpus).selectExpr("sum(xxhash64(id) % 1000) AS s")
    run(fixed)
    machine = round(statistics.median(run(fixed) for _ in range(runs)), 3)
    times = {}
    for name in HEADLINE:
        q = catalog.QUERIES[name]
        run(q(spark, sf_dir))  # warm-up
        times[name] = round(statistics.median(run(q(spark, sf_dir)) for _ in range(runs)), 3)
    if os.environ.get("BENCH_STREAMING", "1") == "1":
        from keyweave.streaming.bench import streaming_rates

        times.update(streaming_rates(spark, sf_dir))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    batch = [v for k, v in times.items() if not k.endswith("_rows_per_s")]
    print(json.dumps({
        "metric": "headline_batch_total",
        "value": round(sum(batch), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "shuffle_partitions": max(cpus, 8),
        "runs": runs,
        "machine_s": machine,
    }))


if __name__ == "__main__":
    main()
