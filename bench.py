"""Benchmark: full project build at $BENCH_SF_DIR on local[$BENCH_CPUS].

Steps (each timed): ingest the five inputs from the driver tables into tables, build the
intermediate tables and every mart table, run the 48 declared checks and one snapshot
(SCD-2) run, then run every dashboard report over the written marts. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from claimlake.plans.build import build, ingest
    from claimlake.session import build_session, shared_dir

    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8),
                          conf={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")})
    root = shared_dir(spark, f"bench-{int(time.time())}")
    t_all = time.time()
    rows: dict[str, int] = {}
    threads = int(os.environ.get("BENCH_THREADS", "4"))
    ing = ingest(spark, sf_dir, os.path.join(root, "raw"), rows, threads=threads)
    t_ing = time.time() - t_all
    prj, times = build(spark, os.path.join(root, "raw"), os.path.join(root, "warehouse"),
                       threads=threads, snapshot_at="2024-01-01 00:00:00")
    # Dashboard path: every report over the written marts (small results, collected).
    from claimlake.plans.reports import REPORTS
    for name, fn in REPORTS.items():
        t0 = time.time()
        fn(prj).collect()
        times[name] = time.time() - t0
    total = time.time() - t_all
    queries = {"ingest": round(t_ing, 3)}
    queries.update({k: round(v, 3) for k, v in times.items()})
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "full_build_seconds", "value": round(total, 3), "unit": "sec",
                      "queries": queries, "sf": sf, "cpus": cpus, "threads": threads,
                      "input_rows": rows,
                      "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
