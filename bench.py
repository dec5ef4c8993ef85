"""Bench: headline change-apply queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is forced with the ``noop`` sink (full execution, nothing collected to the driver).
A warm-up run on the smallest tables is not timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rowtide.plans import queries as Q  # noqa: E402
from rowtide.session import local_session  # noqa: E402

HEADLINE = ["apply_mixed_log", "packet_outcomes", "apply_partial_log", "pipeline_batch", "capture_diff", "apply_set_unique"]


def run(spark, name: str, sf: str) -> float:
    t0 = time.time()
    Q.queries()[name](spark, sf).write.format("noop").mode("overwrite").save()
    spark.catalog.clearCache()
    return time.time() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=max(8, int(cpus) * 2) if cpus.isdigit() else 16, app="rowtide-bench")
    run(spark, "apply_mixed_log", "/root/testdata/sf0.001")  # warm-up, not timed
    times = {name: round(run(spark, name, sf), 3) for name in HEADLINE}
    events = spark.read.parquet(f"{sf}/events.parquet").count()
    out = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf.rsplit("sf", 1)[-1],
        "packets_per_sec_apply_mixed_log": round(events / times["apply_mixed_log"], 1),
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
