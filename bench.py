"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the no-op sink (no collect to the driver) and
timed, after an untimed warm-up pass on sf0.001; prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from seqflow.catalog import QUERIES  # noqa: E402
from seqflow.session import build_session  # noqa: E402

HEADLINE = [
    "prepare_features_summary",  # flagship: prepare job + 19 features + per-part summary
    "feature_set",               # 19 features, row level
    "prepare_job",
    "chunk_sequences",
    "split_groups",
    "scaler_apply",
    "resample",
    "row_index",
    "event_features",
    "ingest_job",
    "best_epoch",
    "class_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    # Warm-up, not timed: every headline query once on the smallest scale factor, so the
    # timings below measure steady-state execution, not JVM class loading / JIT / codegen.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in HEADLINE:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
