"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line.

Each query is fully executed with the ``noop`` sink (every row produced, no
collect to the driver).  An untimed warm-up pass runs every query once on
the smallest data set (JIT, class loading); the timed pass runs every query
once at $BENCH_SF_DIR, with the cache cleared before each.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strideframe.plans.registry import QUERIES  # noqa: E402
from strideframe.session import build_session  # noqa: E402

HEADLINE = [
    "distance_per_entity", "possession_per_entity", "clutch_efficiency", "shot_locations",
    "distance_unfiltered", "jump_report", "gap_report", "text_shots_located", "height_coverage",
    "table_profile", "moment_completeness", "dedupe_first", "margin_forward_fill", "event_path_length",
    "linear_score_array", "linear_score_columns",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 8),
                          extra={"spark.driver.memory": "16g"})
    # untimed warm-up: every query once on the smallest data (JIT, class loading)
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        for name in names:
            QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    spark.catalog.clearCache()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        spark.catalog.clearCache()      # no query profits from another one's persisted sides
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
