"""Streaming throughput of the employee topology on a file replay of ``events``.

The personal and address streams are written as time slices under the shared
checkpoint folder, then each topology (eager and settled join → last-write-wins
table) runs over them with ``availableNow`` (one slice per micro-batch) into the
update-log sink; the settled join also runs in the Python processor. Rate = input rows / wall seconds.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession

from keyweave.session import ensure_checkpoint_dir
from keyweave.streaming.replay import replay_stream, write_event_replay
from keyweave.streaming.topology import start_employee_table

def streaming_rates(spark: SparkSession, sf_dir: str, *, slices: int = 4,
                    window_ms: int | None = None) -> dict[str, float]:
    from keyweave.plans.catalog import WINDOW_MS

    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bench-{uuid.uuid4().hex[:8]}"
    n = write_event_replay(spark, sf_dir, f"{base}/src", slices)
    rates = {}
    runs = [("eager", "eager", "native"), ("settled", "settled", "native"),
            ("settled_processor", "settled", "processor")]
    for name, emit, method in runs:
        t0 = time.perf_counter()
        q = start_employee_table(
            spark, replay_stream(spark, f"{base}/src", "personal"),
            replay_stream(spark, f"{base}/src", "address"), f"{base}/{name}/table",
            name=f"bench_{name}", checkpoint=f"{base}/{name}/checkpoint",
            trigger={"availableNow": True}, emit=emit, window_ms=window_ms or WINDOW_MS,
            settled_method=method)
        q.awaitTermination()
        secs = time.perf_counter() - t0
        rates[f"stream_{name}_table_rows_per_s"] = round(n / secs, 1)
    return rates
