"""Benchmark the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the benchmark set), BENCH_REPEAT (default 3; the best counts).
Each query is run to completion through the ``noop`` sink (full plan, nothing
collected).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["chunk_sections", "vector_topk", "lexical_topk", "build_prompts", "document_status", "replace_files",
            "ledger_durations", "ivf_topk", "ingest_scan"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    from quarry.plans.catalog import QUERIES
    from quarry.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2)
    # warm the JVM (JIT) and the Python workers on a smaller scale factor first
    for warm in ("sf0.01", "sf0.001"):
        warm_dir = os.path.join(os.path.dirname(sf_dir), warm)
        if os.path.isdir(warm_dir) and warm_dir != sf_dir:
            for n in names:
                run(QUERIES[n](spark, warm_dir))
            break
    times = {}
    for n in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            run(QUERIES[n](spark, sf_dir))
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[n] = round(best, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
