"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (no driver collect).
Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    from tessera.registry import all_queries
    from tessera.session import get_session
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    # warm the JVM (class loading, codegen caches) outside the timings
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name, q in all_queries().items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            q.fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t0, 3)
        except Exception as e:  # noqa: BLE001
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
        print(f"# {name} {times.get(name, 'FAILED')}", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
           "n_queries": len(times)}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))


if __name__ == "__main__":
    main()
