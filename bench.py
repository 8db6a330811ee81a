"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line with per-query warm seconds (median of N runs). Queries of
several runs, landed files or streams are whole jobs; they run if $BENCH_RUNS is 1
or they are named in $BENCH_QUERIES.

Each run materialises the full result through the no-op sink (all columns,
all rows) so nothing is pruned away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline.catalog import QUERIES  # noqa: E402
from ledgerline.run_queries import RUNS  # noqa: E402
from ledgerline.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    jobs = set() if os.environ.get("BENCH_RUNS") == "1" else set(RUNS)
    names = only or [q for q in QUERIES if q not in jobs]
    # spark.checkpoint.dir comes from the session defaults when the platform
    # names one; ledgerline.session.checkpoint_dir falls back only if unset
    # local mode: one shuffle partition per core gives one even wave of reduce
    # tasks (measured: 16 on 8 cores let AQE coalesce into 12 uneven tasks)
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=parts,
                        extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "4g")})
    out = {}
    for n in names:
        times = []
        for _ in range(reps + 1):           # first run warms JIT / file listing
            t = time.perf_counter()
            QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t)
        out[n] = round(statistics.median(times[1:]), 3)
        print(f"# {n}: {out[n]}s (cold {times[0]:.2f}s)", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
