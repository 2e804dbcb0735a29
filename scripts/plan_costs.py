"""Jobs, bytes read and bytes shuffled for design alternatives, from Spark's
event log (written to a fresh scratch folder).

* gold_write_once    – dimension, fact (written once), aggregate read from the written fact
* gold_fact_twice    – the same three writes with the aggregate built from the fact's plan
* contract_fused     – the customer suite in one fused pass
* contract_per_rule  – the same four rules, one Spark job (or more) each
* hot_salted         – hot-key fact (a third of sales on one product) joined with products as beyond the
                       broadcast bound, heavy keys salted, then the monthly grouping
* hot_plain          – the same with a plain shuffle join (no key salted)

Usage: python scripts/plan_costs.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratum.operators import contracts as ct  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from stratum.operators.joins import skew_join  # noqa: E402
from stratum.operators.gold import build_customer_dimension, build_monthly_sales_aggregate, build_sales_fact  # noqa: E402
from stratum.plans.pipelines import run_timestamp  # noqa: E402
from stratum.session import local_session, scratch_path  # noqa: E402
from stratum.sources import fixtures as fx  # noqa: E402
from stratum.sources.lake import read_path, write_table  # noqa: E402


def gold(spark, base, write_once: bool) -> None:
    root = scratch_path(spark, "gold_costs")
    sales = fx.transactions_cleansed(spark, base)
    customers = fx.customers_conformed(spark, base)
    products = fx.products_conformed(spark, base)
    at = run_timestamp()
    write_table(build_customer_dimension(customers, at), f"{root}/dim_customer")
    fact = build_sales_fact(sales, customers, products, at)
    write_table(fact, f"{root}/fact_sales", partition_cols=["date_key"])
    source = read_path(spark, f"{root}/fact_sales", schema=fact.schema) if write_once else fact
    write_table(build_monthly_sales_aggregate(source), f"{root}/agg_monthly_sales")


def hot(spark, base, salted: bool) -> None:
    # one task per shuffle partition (no coalescing), so a hot partition shows
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        joined = skew_join(fx.transactions_hot(spark, base), fx.products_conformed(spark, base), "product_id",
                           "left", max_broadcast_rows=0, min_share=0.01 if salted else 2.0)
        monthly = joined.groupBy(F.substring("date_key", 1, 6), "store_id", "product_id").agg(
            F.sum("quantity"), F.count("standard_cost"))
        monthly.write.format("noop").mode("overwrite").save()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def contract(spark, base, fused: bool) -> None:
    df = fx.customers_conformed(spark, base)
    rules = ct.customer_contract()
    if fused:
        ct.validate(df, rules, fail_on_error=False)
    else:
        for rule in rules:
            ct.validate(df, [rule], fail_on_error=False)


def main() -> None:
    base = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = local_session("stratum-costs", checkpoint_dir=tempfile.mkdtemp(prefix="run-", dir="/tmp"),
                          extra_conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                      "spark.eventLog.compress": "false"})
    sc = spark.sparkContext
    scenarios = {
        "gold_write_once": lambda: gold(spark, base, True),
        "gold_fact_twice": lambda: gold(spark, base, False),
        "contract_fused": lambda: contract(spark, base, True),
        "contract_per_rule": lambda: contract(spark, base, False),
        "hot_salted": lambda: hot(spark, base, True),
        "hot_plain": lambda: hot(spark, base, False),
    }
    for name, run in scenarios.items():
        sc.setJobGroup(name, name)
        run()
    spark.stop()

    stage_group: dict[int, str] = {}
    out = defaultdict(lambda: {"jobs": 0, "bytes_read": 0, "shuffle_bytes_written": 0, "tasks": 0})
    shuffle_records = defaultdict(list)  # per task that read shuffle data
    task_ms = defaultdict(list)
    for path in sorted(p for p in glob.glob(f"{log_dir}/**", recursive=True) if os.path.isfile(p)):
        with open(path) as fh:
            for line in fh:
                try:
                    ev = json.loads(line)
                except json.JSONDecodeError:
                    continue
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    if group in scenarios:
                        out[group]["jobs"] += 1
                        for sid in ev.get("Stage IDs", []):
                            stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    metrics = ev.get("Task Metrics") or {}
                    if group:
                        out[group]["tasks"] += 1
                        out[group]["bytes_read"] += (metrics.get("Input Metrics") or {}).get("Bytes Read", 0)
                        out[group]["shuffle_bytes_written"] += (
                            (metrics.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0))
                        records = (metrics.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                        if records:
                            shuffle_records[group].append(records)
                        info = ev.get("Task Info") or {}
                        task_ms[group].append(info.get("Finish Time", 0) - info.get("Launch Time", 0))
    for k in scenarios:
        recs = sorted(shuffle_records[k])
        if recs:
            out[k]["max_task_shuffle_records"] = recs[-1]
            out[k]["median_task_shuffle_records"] = recs[len(recs) // 2]
        out[k]["max_task_ms"] = max(task_ms[k], default=0)
    print(json.dumps({"sf_dir": base, **{k: out[k] for k in scenarios}}, indent=1))


if __name__ == "__main__":
    main()
