"""Times the headline queries; prints one JSON line.

All queries run once to warm up the JVM, then each RUNS times into a sink that discards the rows;
the median counts. Those in ONCE train models for minutes and run a single time. BENCH_SF_DIR and BENCH_CPUS choose the data and the number of threads.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from footfall.catalog import QUERIES
from footfall.session import local_session

HEADLINE = [
    "action_counts",
    "video_length_launch_stats",
    "time_of_day_stats",
    "time_diff_stats",
    "watch_gap_stats",
    "interval_stats",
    "item_popularity",
    "repeat_interest_max",
    "favourite_type",
    "rec_type_pivot",
    "day_period_pivot",
    "sparse_click_pivot",
    "tag_topn_counts",
    "missing_rates",
    "stratified_folds",
    "auc_rank",
    "tail_rate_sweep",
    "staged_auc",
    "user_features",
    "ratio_grid",
    "gbt_auc",
]
RUNS = 3
ONCE = {"gbt_auc"}


def seconds(spark, sf: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    names, times = sys.argv[1:] or HEADLINE, {}
    for name in names:
        if name not in ONCE:
            seconds(spark, sf, name)
    for name in names:
        runs = 1 if name in ONCE else RUNS
        times[name] = round(statistics.median(seconds(spark, sf, name) for _ in range(runs)), 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
