"""Benchmark the headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, optional), BENCH_REPEAT (default 3).
Each query is executed in full with the ``noop`` sink (no driver collect);
the reported time is the best of the repeats after one warm-up run of the
session.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["market_summary", "indicators_long", "indicators_wide", "latest_equity_tick", "strike_distance",
            "build_token_master", "atm_straddle", "near_atm_options", "exact_atm_options", "upsert_ticks_partial",
            "legacy_summary", "filter_technical"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE

    from quantbeam.plans.catalog import queries
    from quantbeam.session import build_session

    spark = build_session(f"local[{cpus}]", app_name="quantbeam-bench", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    qs = queries()
    # warm-up: JIT and file listing caches
    qs["latest_equity_tick"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_headline_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
