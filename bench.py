"""Benchmark the headline queries; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_RUNS`` (default 5). Each query is forced with the
``noop`` sink (every column computed, nothing stored), run once to warm up,
then ``BENCH_RUNS`` times; the median is reported with min/max.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stratum.queries import QUERIES  # noqa: E402
from stratum.session import local_session  # noqa: E402

HEADLINE = (
    "monthly_sales_aggregate",
    "sales_fact",
    "customer_dimension",
    "dedup_latest",
    "upsert_orders",
    "contract_customer_suite",
    "sensitive_scan_documents",
    "demand_features",
    "monthly_sales_hot_keys",  # the at-scale path: salted shuffle joins on a third-of-all-rows key
)


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    shuffle_partitions = str(max(8, 2 * cpus))
    spark = local_session(
        "stratum-bench",
        master=f"local[{cpus}]",
        checkpoint_dir=tempfile.mkdtemp(prefix="run-", dir="/tmp"),
        extra_conf={"spark.sql.shuffle.partitions": shuffle_partitions, "spark.driver.memory": "8g"},
    )
    medians, spread = {}, {}
    for name in HEADLINE:
        times = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            QUERIES[name](spark, base).write.format("noop").mode("overwrite").save()
            if i:  # first run warms up
                times.append(time.perf_counter() - t0)
        medians[name] = round(statistics.median(times), 3)
        spread[name] = [round(min(times), 3), round(max(times), 3)]
    sf = os.path.basename(base.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_sec",
        "value": round(sum(medians.values()), 3),
        "unit": "sec",
        "queries": medians,
        "spread_min_max": spread,
        "sf": sf,
        "config": {"master": f"local[{cpus}]", "runs": runs, "shuffle_partitions": shuffle_partitions,
                   "aqe": spark.conf.get("spark.sql.adaptive.enabled")},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
