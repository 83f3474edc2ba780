"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS.
Every query writes its whole result to a no-op sink; each is run once to warm
up and then timed, the better of two runs counting.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "f1_revenue_by_channel",
    "f2_location_reconciliation",
    "f5_item_metrics",
    "f8_trend_period_by_channel",
    "f10_location_matrix",
    "f13_vendor_breakdown_catering",
    "f15_byo_breakdown",
    "f16_renames_audit",
    "h3_order_rank",
    "h4_vs_prior",
    "h8_subtotals",
    "c2_clean_names",
    "c12_resolve_category",
    "d3_top_payment",
    "d6_orphan_modifiers",
    "d9_cost_lookup",
    "e2_resolve_versions",
    "e6_upsert_dim_item",
    "g3_modifier_cost_by_type",
    "g7_avg_cost_with_modifiers",
    "g8_menu_engineering",
    "b3_explode_selections",
    "b4_walk_modifiers",
    "a1_read_orders",
    "a13_merge_into",
    "g8_menu_report",
    "i3_merge_run",
    "i4_reparse",
]
# Their landed feed and staged tables are kept by the session; timed without that.
COLD = ["a1_read_orders", "i3_merge_run", "i4_reparse"]


def main() -> None:
    from menumix.plans import driver_tables, registry, run_queries
    from menumix.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, memory=os.environ.get("BENCH_MEMORY", "12g"))
    wanted = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in wanted:
        runs = []
        for _ in range(3):
            if name in COLD:
                driver_tables._LANDED.clear()
                run_queries._RUNS.clear()
            start = time.perf_counter()
            registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs[1:]), 3)
        print(f"{name} {[round(r, 2) for r in runs]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
