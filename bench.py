"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` with a ``noop`` sink (full execution, no collect), one
warm-up run and ``$BENCH_RUNS`` timed runs (median), and prints one JSON line.
Plan construction is included in the time (bounds and splits are materialized
while the plan is built).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelkit.plans import QUERIES  # noqa: E402
from panelkit.session import clear_scratch, get_spark  # noqa: E402

HEADLINE = [
    "customer_month_spend",
    "jon9_feature_table",
    "jon9_weekly_feature_table",
    "win14_expanding_quantiles",
    "win16_calendar_stats",
    "win21_weekday_shares",
    "win7_countdown_fill",
    "enr1_coupon_activity",
    "agg1_period_fact",
    "rsh1_pivot_counts",
    "spl1_split_ordered",
    "mat2_best_match",
    "txt1_extract_trade_fields",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = get_spark(f"local[{cpus}]", app="panelkit-bench", shuffle_partitions=2 * cpus,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="panelkit-bench-")})
    times: dict[str, float] = {}
    for name in only or HEADLINE:
        fn = QUERIES[name]

        def run() -> float:
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        run()  # warm-up
        times[name] = round(statistics.median(run() for _ in range(runs)), 3)
        clear_scratch(spark)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
