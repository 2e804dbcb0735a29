import os

from pyspark.sql import functions as F

from stratum.operators import gold
from stratum.operators.gold import (build_customer_dimension, build_monthly_sales_aggregate,
                                    build_sales_fact)
from stratum.sources.lake import write_table

SALES = [("t1", "20240105", 1, 10, 100, 2.0, 3.335), ("t2", "20240120", 2, 11, 100, 1.0, 5.0),
         ("t3", "20240201", 9, 10, 100, 4.0, 1.0), (None, "20240203", 1, 10, 100, 1.0, 1.0)]
SALES_COLS = "transaction_id string, date_key string, customer_id long, product_id long, store_id long, " \
             "quantity double, unit_price double"


def frames(spark, customers):
    sales = spark.createDataFrame(SALES, SALES_COLS)
    cust = spark.createDataFrame(customers, "customer_id long")
    prod = spark.createDataFrame([(10, 1.0)], "product_id long, standard_cost double")
    return sales, cust, prod


def test_fact_measures_and_null_margin(spark):
    sales, cust, prod = frames(spark, [(1,), (2,)])
    rows = {r.transaction_id: r for r in build_sales_fact(sales, cust, prod).collect()}
    assert rows["t1"].total_sales_amount == 6.67
    assert rows["t1"].margin_amount == round((3.335 - 1.0) * 2.0, 2)
    assert rows["t2"].margin_amount is None  # product 11 unknown
    assert rows["t3"].total_sales_amount == 4.0  # customer 9 unknown: row kept


def test_fact_repeats_sales_of_repeated_customers(spark):  # Q7
    sales, cust, prod = frames(spark, [(1,), (1,), (1,), (2,), (None,)])
    fact = build_sales_fact(sales, cust, prod)
    counts = {r[0]: r[1] for r in fact.groupBy("transaction_id").count().collect()}
    assert counts == {"t1": 3, "t2": 1, "t3": 1, None: 3}
    plain = sales.join(cust, "customer_id", "left")
    assert fact.count() == plain.count()


def test_fact_without_customer_join(spark):
    sales, _, prod = frames(spark, [])
    assert build_sales_fact(sales, None, prod).count() == 4


def test_monthly_aggregate_nulls(spark):  # Q14
    sales, cust, prod = frames(spark, [(1,), (2,)])
    agg = {(r.year_month, r.product_id): r for r in build_monthly_sales_aggregate(
        build_sales_fact(sales, cust, prod)).collect()}
    assert agg[("202401", 11)].monthly_margin is None
    assert agg[("202401", 11)].monthly_revenue == 5.0
    assert agg[("202402", 10)].transaction_count == 1  # null id not counted
    assert agg[("202402", 10)].monthly_revenue == 5.0


def test_customer_dimension_full_name(spark):
    cust = spark.createDataFrame(
        [(1, "A", "B", "e", "s", "NA", True), (2, None, None, "e", "s", "NA", True), (2, None, None, "e", "s", "NA", True),
         (3, "C", None, "e", "s", "NA", False)],
        "customer_id long, first_name string, last_name string, email string, segment string, region string, "
        "is_active boolean")
    dim = {r.customer_id: r.full_name for r in build_customer_dimension(cust).collect()}
    assert dim == {1: "A B", 2: "", 3: "C"}


def test_one_timestamp_per_run(spark):
    sales, cust, prod = frames(spark, [(1,)])
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    stamps = {r[0] for r in build_sales_fact(sales, cust, prod, inserted_at=at).select("dw_inserted_at").collect()}
    assert len(stamps) == 1


def test_sums_survive_wild_amounts_and_keep_decimals(spark):
    from pyspark.sql import functions as F

    from stratum.functions.expressions import money_sum

    rows = [("a", 0.1), ("a", 0.2), ("n", float("nan")), ("n", 1.0), ("i", float("inf")), ("h", 1e17), ("h", 1.0), ("z", None),
            ("o", 9e13), ("o", None)] + [("m", 8.9e13)] * 2000
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.s for r in df.groupBy("k").agg(money_sum(F.col("v"), df.schema["v"].dataType).alias("s")).collect()}
    assert got["a"] == 0.3 and got["n"] != got["n"] and got["i"] == float("inf") and got["h"] == 1e17 and got["z"] is None
    assert got["o"] == 9e13 and abs(got["m"] / 1.78e17 - 1) < 1e-9
    dec = df.where("k = 'a'").withColumn("v", F.col("v").cast("decimal(18,2)"))
    out = dec.agg(money_sum(F.col("v"), dec.schema["v"].dataType).alias("s"))
    assert out.schema["s"].dataType.simpleString() == "decimal(28,2)" and str(out.first().s) == "0.30"


def test_monthly_aggregate_by_month_and_slot_shuffles_once(spark, scratch, monkeypatch):
    """With the months' sizes the groups meet and lie by month after one exchange; groups, hot ones and nulls are as without."""
    monkeypatch.setattr(gold, "SLOT_ROWS", 40)
    rows = [(None if i % 11 == 0 else f"t{i}", ["20240105", "20240120", "20240203", None][i % 4], i % 9 if i % 5 else None, i % 60, i / 4, i / 8 if i % 3 else None)
            for i in range(600)] + [("hot", "20240105", 1, 1, 1.25, 0.5)] * 300
    fact = spark.createDataFrame(rows, "transaction_id string, date_key string, store_id long, product_id long, total_sales_amount double, margin_amount double")
    months = {"202401": 600, "202402": 150, "": 150}
    got = gold.build_monthly_sales_aggregate(fact.repartition(5), month_rows=months)
    plain = gold.build_monthly_sales_aggregate(fact)
    assert got.columns == plain.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    even = fact.where("transaction_id is null or transaction_id != 'hot'").where("product_id >= 0")
    monkeypatch.setattr(gold, "heavy_keys", lambda *_: [])
    path = f"{scratch('agg')}/t"
    one = gold.build_monthly_sales_aggregate(even, month_rows=months)
    assert one._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    write_table(one, path, partition_cols=["year_month"], rebalance=False)
    assert sum(n.startswith("part-") for n in os.listdir(f"{path}/year_month=202401")) <= 15  # no more files than slots


def test_fact_measures_are_computed_behind_the_exchange(spark):
    """The rows travel to their day with the columns read only; costs that are broadcast join there."""
    sales = spark.createDataFrame([(f"t{i}", f"2024010{i % 3}", i % 5, i % 7, 1, 2.0, 1.5 * i) for i in range(60)],
                                  "transaction_id string, date_key string, customer_id long, product_id long, store_id long, quantity double, unit_price double")
    customers = spark.createDataFrame([(i,) for i in [0, 1, 1, 2]], "customer_id long")
    products = spark.createDataFrame([(i, i / 2) for i in range(6)], "product_id long, standard_cost double")
    at = F.lit("2024-01-01").cast("timestamp")
    plain = sorted(map(str, gold.build_sales_fact(sales, customers, products, at).collect()))
    for limit in (gold.DEFAULT_BROADCAST_ROWS, 0):
        fact = gold.build_sales_fact(sales, customers, products, at, limit, cluster=["date_key"])
        assert sorted(map(str, fact.collect())) == plain
        moved = fact._jdf.queryExecution().optimizedPlan().toString()
        lines = moved.splitlines()
        exchange = next(k for k, line in enumerate(lines) if "RebalancePartitions" in line)
        assert any("total_sales_amount" in line for line in lines[:exchange]) and not any("total_sales_amount" in line for line in lines[exchange + 1:])
        assert ("LeftOuter" in "\n".join(lines[:exchange])) == (limit > 0)
