"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3) runs after one warm-up; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.catalog import QUERIES  # noqa: E402
from millrace.session import build_session  # noqa: E402

HEADLINE = [
    "report_monthly_amounts",
    "aggregate_conditional_by_date",
    "aggregate_rollup_values",
    "aggregate_duplicate_groups",
    "window_running_stats",
    "window_ranks",
    "window_pick_first",
    "join_star",
    "join_double_lookup",
    "join_currency_inner",
    "join_not_in",
    "join_attribute_lookup",
    "maintain_dedup_lines",
    "maintain_upsert",
    "maintain_net_change",
    "maintain_set_flag",
    "reconcile_diff",
    "quality_report",
    "quality_field_errors",
    "attribution_match",
    "attribution_match_report",
    "attribution_flagged",
    "reservation_by_position",
    "words_bag",
    "html_links_of_length",
    "html_table_cells",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_median_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
