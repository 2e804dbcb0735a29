"""Plan shapes that matter at scale, read from ``explain('formatted')``."""

from pyspark.sql import functions as F

from stratum.operators import contracts as ct
from stratum.operators.conform import dedup_latest
from stratum.operators.gold import build_monthly_sales_aggregate, build_sales_fact
from stratum.operators.upsert import merge_frames
from stratum.queries import QUERIES
from stratum.sources import fixtures as fx
from stratum.sources.tables import read_table
from tests.conftest import SMALL


def plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


def test_contract_suite_reads_the_table_once(spark, capsys):
    df = read_table(spark, SMALL, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("email"), F.col("c_mktsegment").alias("region"))
    text = plan(ct.contract_stats(df, ct.customer_contract() + [ct.unique("email")]), capsys)
    assert text.split("\n\n")[0].count("Scan parquet") == 1  # the tree part of the plan
    assert "Expand" in text


def test_dedup_aggregates_map_side_without_window(spark, capsys):
    text = plan(dedup_latest(read_table(spark, SMALL, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"]),
                capsys)
    assert "Window" not in text
    lines = text.split("\n\n")[0].splitlines()
    aggs = [i for i, line in enumerate(lines) if "Aggregate" in line]
    exchange = next(i for i, line in enumerate(lines) if "Exchange" in line)
    # the tree prints top-down: final aggregate above the exchange, partial below
    assert aggs[0] < exchange < aggs[-1]


def test_fact_is_not_joined_with_the_whole_customer_table(spark, capsys):
    fact = build_sales_fact(fx.transactions_cleansed(spark, SMALL), fx.customers_conformed(spark, SMALL),
                            fx.products_conformed(spark, SMALL))
    text = plan(fact, capsys)
    assert "customer.parquet" not in text  # keys are unique: no customer join at all
    dirty = build_sales_fact(fx.transactions_cleansed(spark, SMALL), fx.customers_dirty(spark, SMALL),
                             fx.products_conformed(spark, SMALL))
    text = plan(dirty, capsys)
    assert "customer.parquet" not in text  # only the checkpointed repeated keys are joined
    assert "Scan ExistingRDD" in text or "LogicalRDD" in text


def test_monthly_aggregate_prunes_columns(spark, capsys):
    text = plan(QUERIES["monthly_sales_aggregate"](spark, SMALL), capsys)
    lineitem_schema = [line for line in text.splitlines() if "ReadSchema" in line and "l_orderkey" in line][0]
    for unused in ("l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_linenumber"):
        assert unused not in lineitem_schema
    assert "PushedFilters" in text


def test_small_upsert_batch_does_not_shuffle_the_target(spark, capsys):
    target = read_table(spark, SMALL, "orders")
    change = target.where("o_orderkey < 5").withColumn("o_orderstatus", F.lit("X"))
    text = plan(merge_frames(target, change, ["o_orderkey"]), capsys)
    assert "BroadcastHashJoin LeftAnti BuildRight" in text


def test_hot_key_results_are_whole(spark):
    """One customer holds a third of all sales and is repeated three times."""
    n = 3000
    sales = spark.range(n).select(
        F.col("id").cast("string").alias("transaction_id"), F.lit("20240115").alias("date_key"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).cast("long").alias("customer_id"),
        (F.col("id") % 5).alias("product_id"), F.lit(1).cast("long").alias("store_id"),
        F.lit(1.0).alias("quantity"), F.lit(2.0).alias("unit_price"))
    customers = spark.range(n).select(F.col("id").alias("customer_id")).union(
        spark.createDataFrame([(7,), (7,)], "customer_id long"))
    products = spark.range(5).select(F.col("id").alias("product_id"), F.lit(1.5).alias("standard_cost"))
    fact = build_sales_fact(sales, customers, products)
    hot = sum(1 for i in range(n) if i % 3 == 0 or i == 7)  # sales of customer 7
    expected = n + 2 * hot  # customer 7 has three rows
    assert fact.count() == expected
    agg = build_monthly_sales_aggregate(fact).agg(F.sum("transaction_count"), F.sum("monthly_revenue")).first()
    assert agg[0] == expected and agg[1] == 2.0 * expected
    latest = dedup_latest(sales.withColumn("k", F.col("customer_id") % 2), ["k"], ["transaction_id"])
    assert latest.count() == 2


def test_salted_join_equals_plain_join_and_breaks_coupling(spark, capsys):
    from stratum.operators.joins import heavy_keys, skew_join

    n = 6000
    big = spark.range(n).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 50)
                                .alias("k"), (F.col("id") * 1.5).alias("x"))
    dim = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v")).union(
        spark.range(5, 6).select(F.col("id").alias("k"), F.lit(-1).cast("long").alias("v")))  # key 5 twice
    assert 5 in heavy_keys(big, "k")
    salted = skew_join(big, dim, "k", "left", max_broadcast_rows=0)
    plain = big.join(dim, "k", "left")
    assert salted.count() == plain.count()
    assert salted.exceptAll(plain.select(*salted.columns)).count() == 0
    agg = salted.groupBy("k").agg(F.sum("x"))
    # the plan a large dimension would get: no automatic broadcast
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(agg, capsys).split("\n\n")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" not in text
    lines = text.splitlines()
    join_at = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    assert any("Exchange" in line for line in lines[:join_at])  # the aggregate shuffles on its own keys


def test_hot_keys_take_salted_shuffle_joins(spark, capsys):
    """A third of all sales on one customer and one product, dimensions
    beyond the broadcast bound: both joins are salted shuffle joins and the
    aggregate still shuffles on its own keys after a partial step."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["monthly_sales_hot_keys"](spark, SMALL), capsys).split("\n\n")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    lines = text.splitlines()
    joins = [i for i, line in enumerate(lines) if "SortMergeJoin" in line]
    assert len(joins) >= 3  # lineitem-orders, customers (salted), products (salted)
    assert "BroadcastHashJoin" not in text
    assert any("Exchange" in line for line in lines[:joins[0]])
    assert any("HashAggregate" in line for line in lines[:joins[0]])


def _scans(df, capsys, table):
    text = plan(df, capsys)
    return [block for block in text.split("\n\n") if "Scan parquet" in block and "Location" in block and f"{table}.parquet" in block]


def test_skew_joins_evaluate_their_input_once(spark, capsys):
    for name in ("monthly_sales_hot_keys", "sales_fact_null_keys", "sales_fact_hot_keys"):
        assert len(_scans(QUERIES[name](spark, SMALL), capsys, "lineitem")) == 1, name


def test_null_keys_are_spread_and_kept(spark):
    from stratum.operators.joins import skew_join

    big = spark.range(4000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 20).alias("k"))
    dim = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # as dealt, before any coalescing
    try:
        out = skew_join(big, dim, "k", "left", max_broadcast_rows=0, salts=16).hint("merge")
        parts = out.where("k is null").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(parts) >= 4 and sum(r["count"] for r in parts) == 1334
        assert out.count() == 4000 and out.where("k is not null and v is null").count() == 0
        assert skew_join(big, dim, "k", "inner", max_broadcast_rows=0).count() == 2666
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_broadcast_bound_counts_bytes(spark):
    from stratum.operators.joins import fits

    rows = spark.range(1000)
    wide = rows.select("id", F.repeat(F.lit("x"), 100_000).alias("k"))
    assert fits(rows) and not fits(wide) and fits(wide, max_bytes=1 << 28)
    assert not fits(rows, max_rows=999) and not fits(rows, max_bytes=7000)
    assert not fits(rows.select(F.array_repeat(F.lit(1.5), 50).alias("v")), max_bytes=100_000)
    assert fits(rows.limit(0).select("id", F.lit("a").alias("s")))


def test_heavy_keys_sketch_finds_a_third_and_nothing_uniform(spark):
    from stratum.operators.joins import heavy_keys

    n = 20000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("s"),
        (F.col("id") % 1000).alias("u"),
        F.lit(None).cast("long").alias("z"),
    )
    assert heavy_keys(df, "s") == ["hot"]
    assert heavy_keys(df, "u") == []  # every key holds 0.1 %
    assert heavy_keys(df, "z") == []
    assert heavy_keys(df.select(F.struct("s").alias("t")), "t") == []  # type the sketch cannot take


def test_guarded_small_upsert_batch_shuffles_only_matching_rows(spark, capsys):
    target = read_table(spark, SMALL, "orders")
    change = target.where("o_orderkey < 5").withColumn("o_orderstatus", F.lit("X"))
    text = plan(merge_frames(target, change, ["o_orderkey"], guard="o_orderdate"), capsys)
    assert "BroadcastHashJoin LeftAnti BuildRight" in text
    assert "BroadcastHashJoin LeftSemi BuildRight" in text
