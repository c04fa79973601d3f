"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local threads (default 8)
BENCH_RUNS    timed runs per query, the median is reported (default 1; one warm-up query precedes)
"""

from __future__ import annotations

import json
import os
import statistics
import time

from checks.queries import queries
from ledgerloom import build_session

HEADLINE = (
    "reconciled_monthly_revenue",
    "buildup_with_product",
    "buildup_main_family",
    "revenue_cube",
    "client_revenue_share",
    "expense_cube_a",
    "expense_control",
    "allocate_weights",
    "allocate_reassign",
    "cutover_union",
    "first_time_company",
    "engagement_by_segment",
    "cumulative_by_calendar",
    "rewards_loaded",
    "rewards_orders",
    "rewards_redeemed",
    "pnl_costs",
    "consolidated_pnl",
)


def run(df) -> None:
    """Compute every row and column without keeping them."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        "bench", f"local[{cpus}]", int(cpus),
        {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    run(registered["reconciled_monthly_revenue"](spark, sf_dir))
    seconds = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs):
            started = time.time()
            run(registered[name](spark, sf_dir))
            taken.append(time.time() - started)
        seconds[name] = round(statistics.median(taken), 3)
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
