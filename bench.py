"""Benchmark: run every registered query over the tables in $BENCH_SF_DIR on
local[$BENCH_CPUS] and print one JSON line with per-query wall-clock seconds.

Each query is fully executed with the ``noop`` sink (all rows produced, nothing
collected to the driver). The session start and a warm-up pass of every query over the
smallest tables (JIT compilation, class loading) are not timed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.queries import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    scratch = tempfile.mkdtemp(prefix="tidemark-bench-")
    extra = {"spark.driver.memory": "16g",
             "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
             "spark.local.dir": os.path.join(scratch, "local")}
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, app_name="tidemark-bench",
                          extra=extra)

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    names = only or list(QUERIES)
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:
            try:
                QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
            except Exception:  # reported by the timed pass below
                pass
    times, errors = {}, {}
    for name in names:
        try:
            times[name] = round(run(name), 3)
        except Exception as e:  # keep measuring the others; report the failure
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
