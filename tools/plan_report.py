"""Final (adaptive) physical plan facts of the headline queries -> PLANS.md.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

QUERIES_TO_REPORT = [
    "daily_features", "hourly_features", "latest_daily_vector", "quality_report", "pit_join",
    "insert_ignore", "ingest_batch", "materialize_latest", "backfill_payload", "online_lookup",
    "history_page", "scan_city_history", "regression_metrics",
]


def final_plan(df) -> str:
    df.collect()  # runs this DataFrame's own query execution (small scales only)
    text = df._jdf.queryExecution().executedPlan().toString()
    # the adaptive plan prints the final plan first, then the initial one
    first = text.split("\n")[0]
    assert "AdaptiveSparkPlan" not in first or "isFinalPlan=true" in first, "plan not final"
    return text.split("+- == Initial Plan ==")[0]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from aerocast.plans.catalog import QUERIES
    from aerocast.session import build_session

    from aerocast.operators.ordered import CHUNK_ROWS_CONF

    spark = build_session("local[8]", 8, app="plan-report", checkpoint_dir=tempfile.mkdtemp())
    print(f"# Final physical plans (adaptive, after execution) at `{os.path.basename(sf)}`\n")
    print("Counts per query: shuffle exchanges (and how many were reused), Parquet scans, "
          "broadcast / sort-merge joins, windows, and the filters pushed into scans. "
          "Produced by `tools/plan_report.py`.\n")
    table(spark, QUERIES, sf, QUERIES_TO_REPORT)
    print(f"\n## Same, with `{CHUNK_ROWS_CONF}` = 500 (keys split into many chunks)\n")
    spark.conf.set(CHUNK_ROWS_CONF, "500")
    table(spark, QUERIES, sf, ["hourly_features", "quality_report", "pit_join", "backfill_payload",
                               "live_serving_row"])
    spark.conf.unset(CHUNK_ROWS_CONF)
    spark.stop()


def table(spark, QUERIES, sf, names) -> None:
    print("| query | exchanges | reused | scans | broadcast joins | sort-merge joins | windows | pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name in names:
        pl = final_plan(QUERIES[name](spark, sf))
        ex = len(re.findall(r"\bExchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", pl))
        reused = len(re.findall(r"Reused(Exchange|QueryStage)", pl))
        scans = len(re.findall(r"FileScan parquet", pl))
        bhj = pl.count("BroadcastHashJoin")
        smj = pl.count("SortMergeJoin")
        win = len(re.findall(r"\bWindow \[", pl))
        pushed = sorted({re.sub(r"#\d+L?", "", p) for p in re.findall(r"PushedFilters: \[([^\]]+)\]", pl)})
        pf = "; ".join(pushed)[:160] or "-"
        print(f"| `{name}` | {ex} | {reused} | {scans} | {bhj} | {smj} | {win} | {pf} |")


if __name__ == "__main__":
    main()
