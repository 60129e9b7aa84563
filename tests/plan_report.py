"""Write PLANS.md: final (post-AQE) physical plans of the key queries.

Usage: python tests/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KEY = ["src_bars", "indicators_long", "indicators_wide", "latest_equity_tick", "build_token_master",
       "near_atm_options", "upsert_ticks_partial", "market_summary"]


def _clean(plan: str) -> str:
    plan = re.sub(r"#\d+L?", "", plan)                  # expression ids
    plan = re.sub(r"\[plan_id=\d+\]", "", plan)
    plan = re.sub(r"file:[^\],]*/", "", plan)            # local paths
    return plan


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from quantbeam.plans.catalog import queries
    from quantbeam.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    qs = queries()
    out = ["# PLANS — final physical plans (after AQE) of key queries", "",
           f"Generated by `python tests/plan_report.py` on `{os.path.basename(sf_dir)}`, `local[8]`. Expression ids",
           "and paths are stripped. Stored products read back from the checkpoint folder appear as plain",
           "Parquet scans (their own plans ran when they were written).", ""]
    for name in KEY:
        df = qs[name](spark, sf_dir)
        # Run this very plan, so that the adaptive one printed is the final one.
        executed = df._jdf.queryExecution().executedPlan()
        executed.execute().count()
        plan = _clean(executed.toString())
        counts = {k: plan.count(k) for k in ["Exchange ", "BroadcastHashJoin", "SortMergeJoin", "HashAggregate",
                                            "SortAggregate", "WindowGroupLimit", "Window ", "FileScan"]}
        out += [f"## `{name}`", "", "Operator counts: " + ", ".join(f"{k.strip()} {v}" for k, v in counts.items()),
                "", "```", plan.rstrip(), "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
