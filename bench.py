"""Benchmark the headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default: HEADLINE), BENCH_REPEAT (default 2). Each query
is built and executed in full with the ``noop`` sink (no collect to the driver),
``BENCH_REPEAT`` times; the reported time is the best run (warm: plan compiled and
code generated once). First-run (cold) times are printed to stderr. A JVM warm-up
query runs first and is excluded.
"""

from __future__ import annotations

import json
import os
import sys
import time

os.environ.setdefault("PEAKCAST_DRIVER_MEMORY", "16g")  # local mode: the driver is the only worker
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from peakcast.plans.registry import QUERIES  # noqa: E402
from peakcast.session import build_session  # noqa: E402
from peakcast.sources.fixture import SCAN_TASKS  # noqa: E402

HEADLINE = [
    "f1_prepared_marks", "a3_family_season_peaks", "a5_season_table", "w4_next_season_frame",
    "v1_season_sequences", "v8_window_samples", "m1_training_set", "m8_persistence_metrics",
    "a6_counts_by_year_season_gender", "p1_page_anchors", "p14_page_rows", "p5_result_urls",
]


def run(spark, name: str, sf: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in (os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES")
                         else HEADLINE) if n in QUERIES]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=2 * cpus)
    spark.conf.set(SCAN_TASKS, str(cpus))  # the bench tables are one row group each
    run(spark, names[0], sf)  # warm-up: JVM, codegen cache, file listing
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    times = {}
    for n in names:
        runs = [run(spark, n, sf) for _ in range(repeat)]
        times[n] = round(min(runs), 3)
        print(f"{n}: best {times[n]}s, first {runs[0]:.3f}s", file=sys.stderr)
    sfv = os.path.basename(sf.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sfv) if sfv.replace(".", "").isdigit() else sfv}))
    spark.stop()


if __name__ == "__main__":
    main()
