"""Registered queries: one callable ``(spark, base) -> DataFrame`` per
operator, each with its DuckDB oracle in ``ORACLES`` where SQL can state it.

Every query reads whole input tables (or views Spark derives from them).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from stratum.functions.expressions import EMAIL_PATTERN, REGION_VALUES
from stratum.operators import conform, gold
from stratum.operators import contracts as ct
from stratum.operators import governance as gv
from stratum.operators import upsert as up
from stratum.oracles import contract_sql
from stratum.oracles import with_views
from stratum.plans import forecast as fc
from stratum.plans import incremental as inc
from stratum.plans import model_choice as mc
from stratum.plans import model_registry as reg
from stratum.plans import pipelines as pl
from stratum.session import scratch_path
from stratum.sources import fixtures as fx
from stratum.sources import landing
from stratum.sources.lake import LakeConfig, read_path, write_table
from stratum.sources.tables import read_table
from stratum.streaming import bronze_stream as bs

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def _without_audit(df: DataFrame) -> DataFrame:
    return df.drop("dw_inserted_at", conform.AUDIT_COLUMN)


def sales_fact_frame(spark: SparkSession, base: str, customers: DataFrame | None = None) -> DataFrame:
    cust = customers if customers is not None else fx.customers_conformed(spark, base)
    return gold.build_sales_fact(
        fx.transactions_cleansed(spark, base), cust, fx.products_conformed(spark, base)
    )


# ---------------------------------------------------------------- Gold (L3, L4, A1)

_MONTHLY_SQL = """
SELECT substr(date_key, 1, 6) AS year_month, {store} AS store_id, {product} AS product_id,
       CAST(sum(CAST(total_sales_amount AS DECIMAL(18,2))) AS DOUBLE) AS monthly_revenue,
       CAST(sum(CAST(margin_amount AS DECIMAL(18,2))) AS DOUBLE) AS monthly_margin,
       count(transaction_id) AS transaction_count
FROM {source}
GROUP BY 1, 2, 3"""


@register("monthly_sales_aggregate", with_views(
    _MONTHLY_SQL.format(store="store_id", product="product_id", source="sales_fact"), "sales_fact"))
def monthly_sales_aggregate(spark: SparkSession, base: str) -> DataFrame:
    return gold.build_monthly_sales_aggregate(sales_fact_frame(spark, base))


@register("monthly_sales_decimal", with_views("""
SELECT substr(date_key, 1, 6) AS year_month, store_id, product_id,
       CAST(sum(CAST(total_sales_amount AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS monthly_revenue,
       CAST(sum(CAST(margin_amount AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS monthly_margin,
       count(transaction_id) AS transaction_count
FROM sales_fact GROUP BY 1, 2, 3""", "sales_fact"))
def monthly_sales_decimal(spark: SparkSession, base: str) -> DataFrame:
    """A1 on decimal amounts: decimals in, exact decimals out."""
    fact = sales_fact_frame(spark, base)
    money = {c: F.col(c).cast("decimal(18,2)") for c in ("total_sales_amount", "margin_amount")}
    return gold.build_monthly_sales_aggregate(fact.withColumns(money))


@register("monthly_sales_by_store", with_views(
    _MONTHLY_SQL.format(
        store="s_nationkey", product="p_brand",
        source="sales_fact f LEFT JOIN supplier ON f.store_id = s_suppkey LEFT JOIN part ON f.product_id = p_partkey",
    ),
    "sales_fact",
))
def monthly_sales_by_store(spark: SparkSession, base: str) -> DataFrame:
    stores, brands = fx.coarse_keys(spark, base)
    fact = gold.coarsen_fact(sales_fact_frame(spark, base), stores, brands)
    return gold.build_monthly_sales_aggregate(fact, "store_nation", "product_brand")


@register("sales_fact", with_views("SELECT * FROM sales_fact", "sales_fact"))
def sales_fact(spark: SparkSession, base: str) -> DataFrame:
    return _without_audit(sales_fact_frame(spark, base))


@register("sales_fact_fanout", with_views("""
SELECT t.transaction_id, t.date_key, t.customer_id, t.product_id, t.store_id, t.quantity, t.unit_price,
       round(t.quantity * t.unit_price, 2) AS total_sales_amount,
       round((t.unit_price - p.standard_cost) * t.quantity, 2) AS margin_amount
FROM transactions_cleansed t
LEFT JOIN (SELECT customer_id FROM customers_dirty) c ON t.customer_id = c.customer_id
LEFT JOIN products_conformed p ON t.product_id = p.product_id""",
    "transactions_cleansed", "customers_dirty", "products_conformed"))
def sales_fact_fanout(spark: SparkSession, base: str) -> DataFrame:
    """Q7: customers with repeated keys multiply their sales rows."""
    return _without_audit(sales_fact_frame(spark, base, fx.customers_dirty(spark, base)))


_HOT_FACT_COLUMNS = ("transaction_id, date_key, customer_id, product_id, store_id, quantity, unit_price, "
                     "total_sales_amount, margin_amount")


def hot_sales_fact(spark: SparkSession, base: str) -> DataFrame:
    """Fact over ``transactions_hot``: one customer (repeated in the customer
    table, so its sales fan out) and one product each hold a third of all
    sales. Both joins are planned as at scale, with the dimension beyond the
    broadcast bound: the hot keys are salted over a shuffle join."""
    return gold.build_sales_fact(fx.transactions_hot(spark, base), fx.customers_dirty(spark, base),
                                 fx.products_conformed(spark, base), max_broadcast_rows=0)


@register("sales_fact_hot_keys", with_views(f"SELECT {_HOT_FACT_COLUMNS} FROM sales_fact_hot", "sales_fact_hot"))
def sales_fact_hot_keys(spark: SparkSession, base: str) -> DataFrame:
    return _without_audit(hot_sales_fact(spark, base))


@register("monthly_sales_hot_keys", with_views(
    _MONTHLY_SQL.format(store="store_id", product="product_id", source="sales_fact_hot"), "sales_fact_hot"))
def monthly_sales_hot_keys(spark: SparkSession, base: str) -> DataFrame:
    return gold.build_monthly_sales_aggregate(hot_sales_fact(spark, base))


_NULL_KEY_SALES = """
SELECT * REPLACE (CASE WHEN t.customer_id % 3 = 0 THEN NULL ELSE t.customer_id END AS customer_id,
                  CASE WHEN t.product_id % 3 = 0 THEN NULL ELSE t.product_id END AS product_id) FROM transactions_cleansed t"""


@register("sales_fact_null_keys", with_views(f"""
SELECT t.transaction_id, t.date_key, t.customer_id, t.product_id, t.store_id, t.quantity, t.unit_price,
       round(t.quantity * t.unit_price, 2) AS total_sales_amount,
       round((t.unit_price - p.standard_cost) * t.quantity, 2) AS margin_amount
FROM ({_NULL_KEY_SALES}) t
LEFT JOIN (SELECT customer_id FROM customers_dirty) c ON t.customer_id = c.customer_id
LEFT JOIN products_conformed p ON t.product_id = p.product_id""",
    "transactions_cleansed", "customers_dirty", "products_conformed"))
def sales_fact_null_keys(spark: SparkSession, base: str) -> DataFrame:
    """L3 with a third of the customer and product keys null and dimensions beyond the broadcast bound: rows with a null key
    stay out of the shuffle, none is lost."""
    none = F.lit(None).cast("bigint")
    sales = fx.transactions_cleansed(spark, base)
    for key in ("customer_id", "product_id"):
        sales = sales.withColumn(key, F.when(F.col(key) % 3 == 0, none).otherwise(F.col(key)))
    return _without_audit(gold.build_sales_fact(sales, fx.customers_dirty(spark, base), fx.products_conformed(spark, base), max_broadcast_rows=0))


@register("customer_dimension", with_views("""
SELECT customer_id, first_name, last_name, concat_ws(' ', first_name, last_name) AS full_name,
       email, segment, region, is_active
FROM customers_conformed
QUALIFY row_number() OVER (PARTITION BY customer_id
        ORDER BY first_name DESC, last_name DESC, full_name DESC, email DESC, segment DESC,
                 region DESC, is_active DESC) = 1""", "customers_conformed"))
def customer_dimension(spark: SparkSession, base: str) -> DataFrame:
    return _without_audit(gold.build_customer_dimension(fx.customers_conformed(spark, base)))


# ---------------------------------------------------------------- Bronze → Silver

EVENTS_SCHEMA = StructType([
    StructField("id", LongType(), False),
    StructField("name", StringType(), True),
    StructField("value", DoubleType(), True),
    StructField("updated_at", TimestampNTZType(), True),
])


@register("schema_enforce", with_views("""
SELECT TRY_CAST(id AS BIGINT) AS id, name, TRY_CAST(value AS DOUBLE) AS value,
       TRY_CAST(updated_at AS TIMESTAMP) AS updated_at
FROM events_bronze""", "events_bronze"))
def schema_enforce(spark: SparkSession, base: str) -> DataFrame:
    return conform.enforce_schema(fx.events_bronze(spark, base), EVENTS_SCHEMA)


@register("dedup_exact", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedup_exact(spark: SparkSession, base: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    return conform.dedup_exact(read_table(spark, base, "lineitem"), keys).select(*keys)


@register("dedup_latest", """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
                 l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1""")
def dedup_latest(spark: SparkSession, base: str) -> DataFrame:
    return conform.dedup_latest(read_table(spark, base, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@register("dedup_latest_hot_keys", """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_returnflag
        ORDER BY l_shipdate DESC, l_orderkey DESC, l_partkey DESC, l_suppkey DESC, l_linenumber DESC,
                 l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_linestatus DESC) = 1""")
def dedup_latest_hot_keys(spark: SparkSession, base: str) -> DataFrame:
    """Latest line per return flag: three keys, each holding about a third
    of all lines (reduced map-side before the shuffle)."""
    return conform.dedup_latest(read_table(spark, base, "lineitem"), ["l_returnflag"], ["l_shipdate"])


@register("clean_events", with_views("SELECT DISTINCT * FROM events_bronze", "events_bronze"))
def clean_events(spark: SparkSession, base: str) -> DataFrame:
    return _without_audit(conform.clean(fx.events_bronze(spark, base)))


# ---------------------------------------------------------------- contracts


_RULE_SQL = {
    "not_null": (ct.NOT_NULL, "customer_id", 1.0, "not_null", None),
    "unique": (ct.UNIQUE, "customer_id", 1.0, "unique", None),
    "regex": (ct.MATCH_REGEX, "email", 0.99, "regex", EMAIL_PATTERN),
    "in_set": (ct.IN_SET, "region", 1.0, "in_set", REGION_VALUES),
}
_RULES = dict(zip(("not_null", "unique", "regex", "in_set"), ct.customer_contract()))
SUITE = "silver_customer_suite"


def _contract_query(rule: str) -> Query:
    def run(spark: SparkSession, base: str) -> DataFrame:
        return ct.contract_stats(fx.customers_dirty(spark, base), [_RULES[rule]], f"{rule}_check", "customers_dirty")

    return run


for _rule in ("not_null", "unique", "regex", "in_set"):
    register(
        f"contract_{_rule}",
        with_views(contract_sql("customers_dirty", [(0, *_RULE_SQL[_rule])], f"{_rule}_check", "customers_dirty"),
                   "customers_dirty"),
    )(_contract_query(_rule))

_SUITE_RULES = [(i, *_RULE_SQL[k]) for i, k in enumerate(("not_null", "unique", "regex", "in_set"))]


@register("contract_customer_suite", with_views(
    contract_sql("customers_conformed", _SUITE_RULES, SUITE, "silver_customers"), "customers_conformed"))
def contract_customer_suite(spark: SparkSession, base: str) -> DataFrame:
    registry = ct.ContractRegistry()
    registry.define(SUITE, ct.customer_contract())
    return registry.stats(fx.customers_conformed(spark, base), SUITE, "silver_customers")


@register("contract_customer_suite_dirty", with_views(
    contract_sql("customers_dirty", _SUITE_RULES, SUITE, "customers_dirty"), "customers_dirty"))
def contract_customer_suite_dirty(spark: SparkSession, base: str) -> DataFrame:
    return ct.contract_stats(fx.customers_dirty(spark, base), ct.customer_contract(), SUITE, "customers_dirty")


_MORE_RULES = [
    (ct.expectation(ct.BETWEEN, column="customer_id", min_value=5, max_value=1000, mostly=0.5), ("bad", "customer_id NOT BETWEEN 5 AND 1000")),
    (ct.expectation(ct.BETWEEN, column="customer_id", min_value=1), ("bad", "customer_id < 1")),
    (ct.expectation(ct.VALUE_LENGTHS, column="email", min_value=10, max_value=17), ("bad", "length(email) NOT BETWEEN 10 AND 17")),
    (ct.expectation(ct.VALUE_LENGTHS, column="region", max_value=5), ("bad", "length(region) > 5")),
    (ct.expectation(ct.OF_TYPE, column="customer_id", type_="bigint"), ("bad", "false")),
    (ct.expectation(ct.OF_TYPE, column="email", type_="int"), ("bad", "true")),
    (ct.expectation(ct.COLUMN_EXISTS, column="segment"), ("table", "count(*) >= 0")),
    (ct.expectation(ct.COLUMN_EXISTS, column="nowhere"), ("table", "count(*) < 0")),
    (ct.expectation(ct.ROW_COUNT, min_value=1), ("table", "count(*) >= 1")),
    (ct.expectation(ct.ROW_COUNT, max_value=3), ("table", "count(*) <= 3")),
    (ct.expectation(ct.COMPOUND_UNIQUE, column_list=["customer_id", "email"]), ("compound", ("customer_id", "email"))),
    (ct.expectation(ct.COMPOUND_UNIQUE, column_list=["customer_id", "email", "segment"], mostly=0.5), ("compound", ("customer_id", "email", "segment"))),
    (ct.expectation(ct.UNIQUE, column="email"), ("unique", None)),
]


@register("contract_more_rules", with_views(contract_sql(
    "customers_dirty", [(i, e.expectation_type, e.name, e.mostly, *sql) for i, (e, sql) in enumerate(_MORE_RULES)],
    "more_rules", "customers_dirty"), "customers_dirty"))
def contract_more_rules(spark: SparkSession, base: str) -> DataFrame:
    """Each further rule type once passing and once failing, in one pass."""
    return ct.contract_stats(fx.customers_dirty(spark, base), [e for e, _ in _MORE_RULES], "more_rules", "customers_dirty")


@register("contract_violations", with_views(f"""
SELECT c.*, 0 AS expectation_index, '{ct.NOT_NULL}' AS expectation_type, 'customer_id' AS column_name FROM customers_dirty c WHERE customer_id IS NULL
UNION ALL SELECT c.*, 1, '{ct.UNIQUE}', 'customer_id' FROM customers_dirty c
  WHERE customer_id IN (SELECT customer_id FROM customers_dirty GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT c.*, 2, '{ct.MATCH_REGEX}', 'email' FROM customers_dirty c WHERE email IS NOT NULL AND NOT regexp_matches(email, '{EMAIL_PATTERN}')
UNION ALL SELECT c.*, 3, '{ct.IN_SET}', 'region' FROM customers_dirty c WHERE region IS NOT NULL AND region NOT IN ({", ".join(f"'{r}'" for r in REGION_VALUES)})""",
    "customers_dirty"))
def contract_violations(spark: SparkSession, base: str) -> DataFrame:
    """The rows that break the customer contract, with the rule they break."""
    return ct.contract_violations(fx.customers_dirty(spark, base), ct.customer_contract())


@register("contract_gate", with_views("SELECT * FROM customers_conformed", "customers_conformed"))
def contract_gate(spark: SparkSession, base: str) -> DataFrame:
    """Rows promoted only after the suite passes (it does here)."""
    return ct.gate(fx.customers_conformed(spark, base), ct.customer_contract(), SUITE, "silver_customers")


# ---------------------------------------------------------------- upsert, storage and layer jobs


_ORDERS_MERGE_SQL = with_views("""
SELECT i.* FROM orders_initial i WHERE NOT EXISTS (SELECT 1 FROM orders_changes c WHERE c.o_orderkey = i.o_orderkey)
UNION ALL SELECT * FROM orders_changes""", "orders_initial", "orders_changes")

_EVENTS_LATEST = """(SELECT * FROM (SELECT TRY_CAST(id AS BIGINT) AS id, name, TRY_CAST(value AS DOUBLE) AS value,
                       TRY_CAST(updated_at AS TIMESTAMP) AS updated_at FROM {src})
      QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS LAST, name DESC NULLS LAST,
                                                        value DESC NULLS LAST) = 1)"""
_EVENTS_MERGE_SQL = with_views(f"""
SELECT t.* FROM {_EVENTS_LATEST.format(src='events_batch_1')} t
WHERE NOT EXISTS (SELECT 1 FROM {_EVENTS_LATEST.format(src='events_batch_2')} s WHERE s.id = t.id)
UNION ALL SELECT * FROM {_EVENTS_LATEST.format(src='events_batch_2')}""", "events_batch_1", "events_batch_2")


def _events_latest(spark: SparkSession, base: str, which: int) -> DataFrame:
    enforced = conform.enforce_schema(fx.events_batch(spark, base, which), EVENTS_SCHEMA)
    return conform.dedup_latest(enforced, ["id"], ["updated_at"])


@register("upsert_orders", _ORDERS_MERGE_SQL)
def upsert_orders(spark: SparkSession, base: str) -> DataFrame:
    """D1 as a DataFrame: change batch merged into the first orders load."""
    return up.merge_frames(fx.orders_initial(spark, base), fx.orders_changes(spark, base), ["o_orderkey"])


@register("upsert_events", _EVENTS_MERGE_SQL)
def upsert_events(spark: SparkSession, base: str) -> DataFrame:
    return up.merge_frames(_events_latest(spark, base, 1), _events_latest(spark, base, 2), ["id"])


@register("upsert_roundtrip", _ORDERS_MERGE_SQL)
def upsert_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    """Initial load, staged bucket upsert, then the same change
    batch replayed (must not change the table)."""
    path = scratch_path(spark, "silver_orders")
    up.upsert_table(fx.orders_initial(spark, base), path, ["o_orderkey"], buckets=16)
    up.upsert_table(fx.orders_changes(spark, base), path, ["o_orderkey"], buckets=16)
    up.upsert_table(fx.orders_changes(spark, base), path, ["o_orderkey"], buckets=16)
    return spark.read.parquet(path).drop(up.BUCKET)


@register("bronze_to_silver_events", _EVENTS_MERGE_SQL)
def bronze_to_silver_events(spark: SparkSession, base: str) -> DataFrame:
    """L1 twice: each arrival batch is landed in Bronze, cleaned, enforced
    and upserted into Silver by id."""
    root = scratch_path(spark, "events_layers")
    silver = f"{root}/silver/events"
    for which in (1, 2):
        bronze = f"{root}/bronze/events/batch={which}"
        fx.events_batch(spark, base, which).write.mode("overwrite").parquet(bronze)
        pl.bronze_to_silver(spark, bronze, silver, schema=EVENTS_SCHEMA, buckets=16,
                            contract=[ct.not_null("id"), ct.not_null("updated_at")])
    return spark.read.parquet(silver).drop(up.BUCKET, conform.AUDIT_COLUMN)


@register("gold_partitioned_roundtrip", with_views("SELECT * FROM sales_fact", "sales_fact"))
def gold_partitioned_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    """Fact written partitioned by day, read back with its schema
    (``date_key`` stays a string)."""
    fact = sales_fact_frame(spark, base)
    path = scratch_path(spark, "gold_fact_sales")
    write_table(fact, path, partition_cols=["date_key"])
    return _without_audit(read_path(spark, path, schema=fact.schema))


@register("silver_to_gold_aggregate", ORACLES["monthly_sales_aggregate"])
def silver_to_gold_aggregate(spark: SparkSession, base: str) -> DataFrame:
    """Silver tables staged, Gold job run with the customer gate,
    aggregate read back from Gold."""
    root = scratch_path(spark, "lake")
    cfg = LakeConfig.from_mapping({"silver_base_path": f"{root}/silver", "gold_base_path": f"{root}/gold"})
    write_table(fx.transactions_cleansed(spark, base), cfg.silver("transactions_cleansed"))
    write_table(fx.customers_conformed(spark, base), cfg.silver("customers_conformed"))
    write_table(fx.products_conformed(spark, base), cfg.silver("products_conformed"))
    paths = pl.silver_to_gold(spark, cfg, customer_contract=ct.customer_contract())
    return spark.read.parquet(paths["agg_monthly_sales"]).drop("dw_inserted_at")


def _lake(spark: SparkSession, purpose: str) -> LakeConfig:
    root = scratch_path(spark, purpose)
    return LakeConfig.from_mapping({"silver_base_path": f"{root}/silver", "gold_base_path": f"{root}/gold"})


@register("gold_lineage", with_views(f"""
SELECT *, transaction_count AS with_known_file, 'silver_to_gold.sales_fact:v1' AS process_qualified_name,
       'silver.transactions_cleansed' AS source_qualified_name, 'gold.fact_sales' AS target_qualified_name
FROM (SELECT year_month, store_id, product_id, transaction_count FROM ({_MONTHLY_SQL.format(store="store_id", product="product_id", source="sales_fact")}) m)""", "sales_fact"))
def gold_lineage(spark: SparkSession, base: str) -> DataFrame:
    """The Gold job writes files, processes and coded rows; decoded and regrouped they give the aggregate's
    transaction_count, each transaction with a file of the Silver table."""
    cfg = _lake(spark, "lake_lineage")
    write_table(fx.transactions_cleansed(spark, base), cfg.silver("transactions_cleansed"))
    write_table(fx.customers_conformed(spark, base), cfg.silver("customers_conformed"))
    write_table(fx.products_conformed(spark, base), cfg.silver("products_conformed"))
    pl.silver_to_gold(spark, cfg, lineage=True, fact_partition_cols=())  # day partitions: see silver_to_gold_aggregate
    rows = gv.expand_lineage(*pl.read_lineage(spark, cfg))
    known = F.col("source_file").contains("/silver/transactions_cleansed/")
    return rows.groupBy("year_month", "store_id", "product_id", "process_qualified_name", "source_qualified_name", "target_qualified_name").agg(
        F.count("transaction_id").alias("transaction_count"), F.count_if(known).alias("with_known_file"))


@register("gold_incremental", with_views(
    _MONTHLY_SQL.format(store="store_id", product="product_id", source="sales_fact_fanned"), "sales_fact_fanned"))
def gold_incremental(spark: SparkSession, base: str) -> DataFrame:
    """L5 by changed days: a first run without the late sales and with other costs for some products and without the
    repeated customers, then a second run on the Silver tables as they are. Equal to a full rebuild."""
    cfg = _lake(spark, "lake_incremental")
    sales, products = fx.transactions_cleansed(spark, base), fx.products_conformed(spark, base)
    late = (F.col("date_key") % 5 == 0) & (F.col("store_id") % 3 == 0) | F.col("date_key").between("19950101", "19950630")
    write_table(sales.where(~late), cfg.silver("transactions_cleansed"))
    write_table(fx.customers_conformed(spark, base), cfg.silver("customers_conformed"))
    write_table(products.withColumn("standard_cost", F.when(F.col("product_id") % 97 == 0, 1.0).otherwise(F.col("standard_cost"))),
                cfg.silver("products_conformed"))
    inc.silver_to_gold_incremental(spark, cfg)
    write_table(sales.where(late), cfg.silver("transactions_cleansed"), mode="append")
    write_table(fx.customers_dirty(spark, base), cfg.silver("customers_conformed"))
    write_table(products, cfg.silver("products_conformed"))
    inc.silver_to_gold_incremental(spark, cfg)
    return inc.read_monthly(spark, cfg).drop("dw_inserted_at")


@register("bronze_to_silver_quarantine", with_views(f"""
, broken AS (SELECT *, [{", ".join(f"CASE WHEN {cond} THEN '{kind}' END" for kind, cond in (
    (ct.NOT_NULL, "customer_id IS NULL"), (ct.UNIQUE, "customer_id IS NOT NULL AND count(*) OVER (PARTITION BY customer_id) > 1"),
    (ct.MATCH_REGEX, f"email IS NOT NULL AND NOT regexp_matches(email, '{EMAIL_PATTERN}')"),
    (ct.IN_SET, "region IS NOT NULL AND region NOT IN (" + ", ".join(f"'{r}'" for r in REGION_VALUES) + ")")))}] AS rules FROM customers_dirty)
SELECT * EXCLUDE (rules, r), CASE WHEN r = '' THEN 'promoted' ELSE 'quarantined' END AS part, r AS broken_rules
FROM (SELECT *, array_to_string(list_filter(rules, lambda x: x IS NOT NULL), ',') AS r FROM broken)""", "customers_dirty").replace("\n\n, broken AS", ",\nbroken AS"))
def bronze_to_silver_quarantine(spark: SparkSession, base: str) -> DataFrame:
    """R10/L1 without a halt: rows that keep the customer contract are promoted, the others are quarantined with
    the rules they break; no row is lost."""
    root = scratch_path(spark, "quarantine")
    fx.customers_dirty(spark, base).write.parquet(f"{root}/bronze")
    pl.bronze_to_silver(spark, f"{root}/bronze", f"{root}/silver", keys=["customer_id"], order_by=["email"], contract=ct.customer_contract(),
                        quarantine_path=f"{root}/quarantine", run_id="1")
    good = spark.read.parquet(f"{root}/silver").drop(up.BUCKET, conform.AUDIT_COLUMN)
    held = spark.read.parquet(f"{root}/quarantine")
    rules = F.array_join(F.transform("broken_rules", lambda r: r["expectation_type"]), ",")
    return good.select("*", F.lit("promoted").alias("part"), F.lit("").alias("broken_rules")).unionByName(
        held.select(*good.columns, F.lit("quarantined").alias("part"), rules.alias("broken_rules")))


@register("contract_history", with_views("SELECT '1' AS run_id, * FROM (" + contract_sql("customers_dirty", _SUITE_RULES, SUITE, "silver_customers") + """)
UNION ALL SELECT '2', * FROM (""" + contract_sql("customers_conformed", _SUITE_RULES, SUITE, "silver_customers") + ")", "customers_dirty", "customers_conformed"))
def contract_history(spark: SparkSession, base: str) -> DataFrame:
    """The results of two runs kept as a table; the second run is repeated and still there once."""
    path = scratch_path(spark, "contract_history")
    for run, table in (("1", fx.customers_dirty), ("2", fx.customers_conformed), ("2", fx.customers_conformed)):
        ct.validate(table(spark, base), ct.customer_contract(), SUITE, "silver_customers", False, path, run)
    return ct.read_history(spark, path).drop("recorded_at")


@register("bronze_landing", "SELECT *, 'orders.parquet' AS source_file_name FROM orders")
def bronze_landing(spark: SparkSession, base: str) -> DataFrame:
    """Source columns kept as they are, plus the source file. The batch
    is landed twice under one batch id (a retried job): it is there once."""
    path = scratch_path(spark, "bronze_orders")
    for _ in range(2):
        landing.land_batch(spark, f"{base}/orders.parquet", path, batch_id="orders-0001")
    landed = spark.read.parquet(path)
    return landed.withColumn("source_file_name", landing.file_name()).drop(
        landing.SOURCE_FILE, landing.INGESTED_AT, landing.LANDING_BATCH)


_DRIFT_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
_DRIFT_SQL = """
SELECT 'csv' AS source, CASE WHEN k % 11 = 0 THEN NULL ELSE CAST(k AS VARCHAR) END AS o_orderkey,
       CASE WHEN k % 11 > 0 AND k % 3 < 2 THEN CAST(o_custkey AS VARCHAR) END AS o_custkey, CASE WHEN k % 11 > 0 THEN o_orderstatus END AS o_orderstatus,
       CASE WHEN k % 11 > 0 THEN o_orderpriority END AS o_orderpriority,
       CASE WHEN k % 11 = 0 THEN '{"record":"' || k || ',too,many,fields,in,this,record"}' WHEN k % 3 = 2 THEN '{"clerk":"c' || k || '"}' END AS _rescued
FROM (SELECT *, o_orderkey AS k FROM orders)
UNION ALL
SELECT 'json', CASE WHEN k % 11 = 0 THEN NULL ELSE CAST(k AS VARCHAR) END, CASE WHEN k % 11 > 0 THEN CAST(o_custkey AS VARCHAR) END,
       CASE WHEN k % 11 > 0 AND k % 5 > 0 THEN o_orderstatus END, CASE WHEN k % 11 > 0 THEN o_orderpriority END,
       CASE WHEN k % 11 = 0 THEN '{"o_orderkey": ' || k || ', "o_custkey' WHEN k % 5 = 0 THEN '{"clerk":"c' || k || '","note":"n"}' END
FROM (SELECT *, o_orderkey AS k FROM orders)"""


@register("bronze_landing_rescued", _DRIFT_SQL)
def bronze_landing_rescued(spark: SparkSession, base: str) -> DataFrame:
    """R1 on CSV and JSON files: columns in another order, missing and new ones, records with too many fields and broken JSON
    lines. All land by name, none is lost; each batch lands twice and is there once."""
    root = scratch_path(spark, "bronze_rescued")
    k = F.col("o_orderkey")
    orders = read_table(spark, base, "orders").select(k, "o_custkey", "o_orderstatus", "o_orderpriority")
    clerk = F.concat(F.lit("c"), k).alias("clerk")
    good = orders.where(k % 11 > 0)
    good.where(k % 3 == 0).write.csv(f"{root}/csv/a", header=True)
    good.where(k % 3 == 1).select("o_orderstatus", "o_orderpriority", "o_custkey", k).write.csv(f"{root}/csv/b", header=True)
    good.where(k % 3 == 2).select("o_orderstatus", clerk, k, "o_orderpriority").write.csv(f"{root}/csv/c", header=True)
    broken = orders.where(k % 11 == 0)
    # a header and a record that has more fields than it
    lines = broken.select(F.explode(F.array(F.lit("o_orderkey,o_custkey"), F.concat(k, F.lit(",too,many,fields,in,this,record")))).alias("value"))
    lines.distinct().repartition(1).sortWithinPartitions(F.desc("value")).write.text(f"{root}/csv/d")  # the header first
    drift = good.where(k % 5 == 0).select(k, "o_custkey", F.lit("n").alias("note"), clerk, "o_orderpriority")
    good.where(k % 5 > 0).write.json(f"{root}/json/a")
    drift.write.json(f"{root}/json/b")
    broken.select(F.concat(F.lit('{"o_orderkey": '), k, F.lit(', "o_custkey'))).write.text(f"{root}/json/c")
    for _ in range(2):
        for fmt in ("csv", "json"):
            landing.land_rescued(spark, f"{root}/{fmt}/*", f"{root}/bronze", fmt, _DRIFT_COLUMNS, f"orders-{fmt}")
    out = spark.read.parquet(f"{root}/bronze")
    return out.select(F.substring_index(landing.LANDING_BATCH, "-", -1).alias("source"), *_DRIFT_COLUMNS, landing.RESCUED)


# ---------------------------------------------------------------- streaming


BRONZE_EVENTS_SCHEMA = StructType([StructField(c, StringType(), True) for c in ("id", "name", "value", "updated_at", "extra")])
# covers the whole event span of the input (30 days), so nothing is late
STREAM_DELAY = "40 days"


@register("stream_dedup_events", with_views("SELECT DISTINCT * FROM events_bronze", "events_bronze"))
def stream_dedup_events(spark: SparkSession, base: str) -> DataFrame:
    """R2: raw deliveries streamed file by file, re-deliveries dropped by a
    watermark dedup on ``(id, updated_at)``."""
    root = scratch_path(spark, "stream_dedup")
    fx.events_bronze(spark, base).repartition(8).write.parquet(f"{root}/arrivals")
    stream = bs.read_arrivals(spark, f"{root}/arrivals", BRONZE_EVENTS_SCHEMA, max_files_per_trigger=2)
    deduped = bs.dedup_within_watermark(stream, "updated_at", STREAM_DELAY, ["id", "updated_at"])
    bs.run_available(deduped, f"{root}/bronze", f"{root}/checkpoint")
    return spark.read.schema(BRONZE_EVENTS_SCHEMA).parquet(f"{root}/bronze")


@register("stream_dedup_by_id", with_views("""
SELECT 'kept' AS part, id, 1 AS copies FROM (SELECT DISTINCT id FROM events_bronze)
UNION ALL SELECT 'unparseable', id, count(*) FROM events_bronze WHERE value = '12x' GROUP BY id""", "events_bronze"))
def stream_dedup_by_id(spark: SparkSession, base: str) -> DataFrame:
    """R2 on keys without the event time: the newer, later copy of an id arrives first. Every id comes out once; rows
    whose event time does not parse are delivered as well and land in a side table."""
    root = scratch_path(spark, "stream_dedup_by_id")
    bronze = fx.events_bronze(spark, base)
    bronze.orderBy(F.desc("updated_at")).repartition(4).write.parquet(f"{root}/arrivals")
    bronze.where(F.col("value") == "12x").withColumn("updated_at", F.lit("not a time")).write.mode("append").parquet(f"{root}/arrivals")
    stream = bs.read_arrivals(spark, f"{root}/arrivals", BRONZE_EVENTS_SCHEMA, max_files_per_trigger=2)
    good, bad = bs.split_unparseable(stream, "updated_at")
    late = bs.run_available(bs.dedup_within_watermark(good, "updated_at", STREAM_DELAY, ["id"]), f"{root}/bronze", f"{root}/checkpoint")
    bs.run_available(bad, f"{root}/unparseable", f"{root}/checkpoint_bad")
    assert late["late"] == 0
    parts = [spark.read.schema(BRONZE_EVENTS_SCHEMA).parquet(f"{root}/{d}").groupBy("id").agg(F.count(F.lit(1)).alias("copies")).select(
        F.lit(name).alias("part"), "id", "copies") for name, d in (("kept", "bronze"), ("unparseable", "unparseable"))]
    return parts[0].unionByName(parts[1])


@register("stream_upsert_events", _EVENTS_MERGE_SQL)
def stream_upsert_events(spark: SparkSession, base: str) -> DataFrame:
    """Both arrival batches streamed into Silver through ``foreachBatch``
    upserts guarded by ``updated_at``."""
    root = scratch_path(spark, "stream_upsert")
    for which in (1, 2):
        fx.events_batch(spark, base, which).repartition(4).write.mode("append").parquet(f"{root}/arrivals")
    stream = bs.read_arrivals(spark, f"{root}/arrivals", BRONZE_EVENTS_SCHEMA, max_files_per_trigger=3)
    bs.run_stream_upsert(stream, f"{root}/silver", f"{root}/checkpoint", ["id"], ["updated_at"],
                         schema=EVENTS_SCHEMA, guard="updated_at", buckets=16)
    return spark.read.parquet(f"{root}/silver").drop(up.BUCKET)


_LATE_RULE = "CAST(id AS BIGINT) % 13 = 0"  # these deliveries come last, whatever their event time
_ROUNDS = ("2024-01-11", "2024-01-21")


@register("stream_late_rows", with_views(f"""
, b AS (SELECT *, CASE WHEN {_LATE_RULE} THEN 4 WHEN updated_at < '{_ROUNDS[0]}' THEN 1 WHEN updated_at < '{_ROUNDS[1]}' THEN 2 ELSE 3 END AS round,
        CAST(updated_at AS TIMESTAMP) AS ts FROM events_bronze),
w AS (SELECT max(ts) - INTERVAL 5 DAY AS mark FROM b WHERE round < 4)
SELECT part, id, name, value, updated_at, extra, count(*) AS copies FROM (
    SELECT DISTINCT 'kept' AS part, id, name, value, updated_at, extra FROM b, w WHERE round < 4 OR ts >= mark
    UNION ALL SELECT 'late', id, name, value, updated_at, extra FROM b, w WHERE round = 4 AND ts < mark
    UNION ALL SELECT 'unparseable', id, name, value, 'no time', extra FROM events_bronze WHERE value = '12x') GROUP BY ALL""", "events_bronze").replace("\n\n, b AS", ",\nb AS"))
def stream_late_rows(spark: SparkSession, base: str) -> DataFrame:
    """R2 without loss: deliveries held back to the last micro-batch are late where the watermark has passed them. Kept, late and
    unparseable rows are all delivered rows, re-deliveries in time apart."""
    root = scratch_path(spark, "stream_late")
    bronze = fx.events_bronze(spark, base)
    last = F.expr(_LATE_RULE)
    early, middle = F.col("updated_at") < _ROUNDS[0], F.col("updated_at") < _ROUNDS[1]
    rounds = [bronze.where(~last & early), bronze.where(~last & ~early & middle), bronze.where(~last & ~middle), bronze.where(last)]
    rounds[0] = rounds[0].unionByName(bronze.where(F.col("value") == "12x").withColumn("updated_at", F.lit("no time")))
    for rows in rounds:  # one micro-batch each: a trigger takes what has arrived
        rows.write.mode("append").parquet(f"{root}/arrivals")
        stream = bs.read_arrivals(spark, f"{root}/arrivals", BRONZE_EVENTS_SCHEMA)
        bs.land_stream(stream, f"{root}/landed", f"{root}/checkpoint", "updated_at", "5 days", ["id", "updated_at"])
    parts = [bs.read_landed(spark, f"{root}/landed", BRONZE_EVENTS_SCHEMA, p).withColumn("part", F.lit(p)) for p in (bs.KEPT, bs.LATE, bs.UNPARSEABLE)]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.groupBy("part", *BRONZE_EVENTS_SCHEMA.names).agg(F.count(F.lit(1)).alias("copies"))


@register("stream_newest_versions", with_views(f"SELECT * FROM {_EVENTS_LATEST.format(src='events_bronze')}", "events_bronze"))
def stream_newest_versions(spark: SparkSession, base: str) -> DataFrame:
    """R3 with the newest version of each key in state: deliveries in shuffled order, so that older versions come after newer
    ones, give the batch result."""
    root = scratch_path(spark, "stream_newest")
    shuffled = fx.events_bronze(spark, base).repartition(4, F.xxhash64("id", "updated_at", "value"))
    shuffled.write.parquet(f"{root}/arrivals")
    stream = bs.read_arrivals(spark, f"{root}/arrivals", BRONZE_EVENTS_SCHEMA, max_files_per_trigger=2)
    bs.run_stream_upsert_newest(stream, f"{root}/silver", f"{root}/checkpoint", ["id"], "updated_at", EVENTS_SCHEMA, buckets=8)
    return spark.read.parquet(f"{root}/silver").drop(up.BUCKET)


# ---------------------------------------------------------------- governance


_SCAN_COLUMNS = ("text", "lang", "source")


def _scan_sql() -> str:
    parts = [
        f"SELECT '{c}' AS column_name, '{name}' AS pattern, count({c}) AS n_values, "
        f"count_if(regexp_matches({c}, '{pat}')) AS n_flagged FROM documents"
        for c in _SCAN_COLUMNS for name, pat in gv.SENSITIVE_PATTERNS.items()
    ]
    return ("SELECT *, CASE WHEN n_values > 0 THEN CAST(n_flagged AS DOUBLE) / n_values END AS flagged_share FROM ("
            + "\nUNION ALL\n".join(parts) + ")")


@register("sensitive_scan_documents", _scan_sql())
def sensitive_scan_documents(spark: SparkSession, base: str) -> DataFrame:
    return gv.sensitive_scan(read_table(spark, base, "documents"), list(_SCAN_COLUMNS))


@register("sensitive_rows_documents", "\nUNION ALL\n".join(
    f"SELECT doc_id, '{c}' AS column_name, '{name}' AS pattern FROM documents "
    f"WHERE regexp_matches({c}, '{pat}')" for c in _SCAN_COLUMNS for name, pat in gv.SENSITIVE_PATTERNS.items()))
def sensitive_rows_documents(spark: SparkSession, base: str) -> DataFrame:
    return gv.sensitive_rows(read_table(spark, base, "documents"), "doc_id", list(_SCAN_COLUMNS))


def _luhn_sql(x: str) -> str:
    digits = f"regexp_replace({x}, '[ -]', '', 'g')"
    d = f"CAST(substr({digits}, 17 - i, 1) AS INTEGER)"
    return f"list_sum(list_transform(range(1, 17), lambda i: CASE WHEN i % 2 = 1 THEN {d} WHEN 2 * {d} > 9 THEN 2 * {d} - 9 ELSE 2 * {d} END)) % 10 = 0"


def _valid_sql(found: str, name: str) -> str:
    if name == "card_number":
        return f"list_filter({found}, lambda x: {_luhn_sql('x')})"
    if name == "ipv4":
        return f"list_filter({found}, lambda x: len(list_filter(string_split(x, '.'), lambda o: CAST(o AS INTEGER) > 255)) = 0)"
    return found


@register("sensitive_findings_documents", "\nUNION ALL\n".join(
    f"SELECT doc_id, '{c}' AS column_name, '{name}' AS pattern, CAST(len(m) AS BIGINT) AS n_matches, CAST(len({_valid_sql('m', name)}) AS BIGINT) AS n_valid "
    f"FROM (SELECT doc_id, regexp_extract_all({c}, '{pat}') AS m FROM documents) WHERE len(m) > 0"
    for c in _SCAN_COLUMNS for name, pat in gv.SENSITIVE_PATTERNS.items()))
def sensitive_findings_documents(spark: SparkSession, base: str) -> DataFrame:
    """R4, checked: card numbers by their Luhn digit, addresses by their octets."""
    return gv.sensitive_findings(read_table(spark, base, "documents"), "doc_id", list(_SCAN_COLUMNS))


_CARD = "concat('4000 ', substr(lpad(CAST(event_id * 7919 AS {0}), 12, '0'), 1, 4), ' ', substr(lpad(CAST(event_id * 7919 AS {0}), 12, '0'), 5, 4), '-', substr(lpad(CAST(event_id * 7919 AS {0}), 12, '0'), 9, 4))"
_NESTED_VALUES = {
    "info.kind": "event_type", "info.cards[]": _CARD.format("VARCHAR"), "attrs.ip": "concat('10.', event_id % 400, '.0.1')",
    "body.owner.mail": "concat('u', event_id, CASE WHEN event_id % 3 = 0 THEN '@@x' ELSE '@example.com' END)", "body.list[]": "concat('token = \"', event_id, '\"')",
    "body.k": "CAST(event_id AS VARCHAR)", "props.k": "json_extract_string(props, '$.k')"}


@register("sensitive_scan_nested", "WITH v AS (" + "\nUNION ALL\n".join(f"SELECT '{p}' AS path, {x} AS value FROM events" for p, x in _NESTED_VALUES.items())
          + "\nUNION ALL SELECT 'info.cards[]', 'none' FROM events)\n" + "\nUNION ALL\n".join(f"""
SELECT path, '{name}' AS pattern, count(*) AS n_values, count_if(len(m) > 0) AS n_flagged, count_if(len({_valid_sql('m', name)}) > 0) AS n_valid
FROM (SELECT path, regexp_extract_all(value, '{pat}') AS m FROM v WHERE value IS NOT NULL) GROUP BY path""" for name, pat in gv.SENSITIVE_PATTERNS.items()))
def sensitive_scan_nested(spark: SparkSession, base: str) -> DataFrame:
    """R4 inside structs, arrays, maps and JSON texts of the events; a tenth of the card numbers pass their check digit."""
    card = F.expr(_CARD.format("STRING"))
    mail = F.concat(F.lit("u"), "event_id", F.when(F.col("event_id") % 3 == 0, "@@x").otherwise("@example.com"))
    token = F.concat(F.lit('token = "'), "event_id", F.lit('"'))
    events = read_table(spark, base, "events").select(
        F.struct(F.col("event_type").alias("kind"), F.array(card, F.lit("none")).alias("cards")).alias("info"),
        F.create_map(F.lit("ip"), F.concat(F.lit("10."), F.col("event_id") % 400, F.lit(".0.1"))).alias("attrs"),
        F.to_json(F.struct(F.col("event_id").alias("k"), F.struct(mail.alias("mail")).alias("owner"), F.array(token).alias("list"))).alias("body"), "props")
    return gv.sensitive_scan_nested(events, json_columns=["body", "props"])


@register("row_lineage", with_views("""
SELECT substr(date_key, 1, 6) AS year_month, store_id, product_id, transaction_id,
       'lineitem.parquet' AS source_file_name, 'silver_to_gold.monthly_sales' AS process_name,
       'silver_to_gold.monthly_sales:v1' AS process_qualified_name,
       'silver.transactions_cleansed' AS source_qualified_name, 'gold.agg_monthly_sales' AS target_qualified_name
FROM sales_fact WHERE transaction_id IS NOT NULL""", "sales_fact"))
def row_lineage(spark: SparkSession, base: str) -> DataFrame:
    """Gold group → transaction → source file (file name compared)."""
    fact = gold.build_sales_fact(
        fx.transactions_cleansed(spark, base, with_source_file=True),
        fx.customers_conformed(spark, base), fx.products_conformed(spark, base), carry=["_source_file"],
    )
    lineage = gv.row_lineage(fact)
    return lineage.withColumn("source_file_name", landing.file_name("source_file")).drop("source_file")


# ---------------------------------------------------------------- demand features and model


_COARSE_MONTHLY = _MONTHLY_SQL.format(
    store="s_nationkey", product="p_brand",
    source="sales_fact f LEFT JOIN supplier ON f.store_id = s_suppkey LEFT JOIN part ON f.product_id = p_partkey",
)


def _frame(lo: int, hi: int) -> str:
    return f"OVER (PARTITION BY store_id, product_id ORDER BY month_index RANGE BETWEEN {lo} PRECEDING AND {hi} PRECEDING)"


@register("demand_features", with_views(f"""
SELECT store_id, product_id, year_month, month_index, label,
       CAST(sum(CAST(label AS DECIMAL(38,2))) {_frame(1, 1)} AS DOUBLE) AS lag_1,
       CAST(sum(CAST(label AS DECIMAL(38,2))) {_frame(2, 2)} AS DOUBLE) AS lag_2,
       CAST(sum(CAST(label AS DECIMAL(38,2))) {_frame(3, 3)} AS DOUBLE) AS lag_3,
       CASE WHEN count(label) {_frame(3, 1)} > 0
            THEN CAST(sum(CAST(label AS DECIMAL(38,2))) {_frame(3, 1)} AS DOUBLE) / count(label) {_frame(3, 1)}
       END AS rolling_mean_3,
       month_index % 12 + 1 AS month_of_year
FROM (SELECT store_id, product_id, year_month,
             CAST(substr(year_month, 1, 4) AS INTEGER) * 12 + CAST(substr(year_month, 5, 2) AS INTEGER) - 1
               AS month_index,
             monthly_revenue AS label
      FROM ({_COARSE_MONTHLY}) m)""", "sales_fact"))
def demand_features(spark: SparkSession, base: str) -> DataFrame:
    return fc.demand_features(monthly_sales_by_store(spark, base))


_AHEAD_SQL = with_views(f"""
, m AS ({_COARSE_MONTHLY}),
a AS (SELECT year_month, store_id, product_id, monthly_revenue AS label FROM m UNION ALL
      SELECT strftime(strptime((SELECT max(year_month) FROM m) || '01', '%Y%m%d') + INTERVAL 1 MONTH, '%Y%m'), store_id, product_id, NULL
      FROM (SELECT DISTINCT store_id, product_id FROM m)),
i AS (SELECT *, CAST(substr(year_month, 1, 4) AS INTEGER) * 12 + CAST(substr(year_month, 5, 2) AS INTEGER) - 1 AS month_index FROM a)
SELECT store_id, product_id, year_month, label,
       CAST(sum(CAST(label AS DECIMAL(38,2))) {_frame(1, 1)} AS DOUBLE) AS lag_1,
       CAST(sum(CAST(label AS DECIMAL(38,2))) {_frame(2, 2)} AS DOUBLE) AS lag_2,
       CAST(sum(CAST(label AS DECIMAL(38,2))) {_frame(3, 3)} AS DOUBLE) AS lag_3,
       CASE WHEN count(label) {_frame(3, 1)} > 0
            THEN CAST(sum(CAST(label AS DECIMAL(38,2))) {_frame(3, 1)} AS DOUBLE) / count(label) {_frame(3, 1)}
       END AS rolling_mean_3
FROM i""", "sales_fact").replace("\n\n, m AS", ",\nm AS")


def _forecast(spark: SparkSession, base: str) -> tuple[DataFrame, str]:
    """Features (known months and the next) in a Gold table, and the folder of the model fitted on them."""
    root = scratch_path(spark, "demand")
    # the features feed several passes (label spread, fit, scoring): write them
    # once as a Gold table so the joins, aggregate and windows run once
    monthly = f"{root}/gold/monthly_by_store"
    write_table(monthly_sales_by_store(spark, base), monthly)
    write_table(fc.demand_features(fc.with_next_month(read_path(spark, monthly))), f"{root}/gold/demand_features")
    return read_path(spark, f"{root}/gold/demand_features"), root


@register("demand_forecast")
def demand_forecast(spark: SparkSession, base: str) -> DataFrame:
    """Elastic net (alpha 0.5, l1_ratio 0.2) fitted on the features, saved under a version, re-loaded, every
    series-month and the month after the last one scored, and the predictions written to a Gold table that is read back."""
    features, root = _forecast(spark, base)
    fc.save_model(fc.train_demand_model(features), f"{root}/model", "1")
    fc.write_predictions(fc.predict(fc.load_model(f"{root}/model", "1"), features), f"{root}/gold/demand_predictions")
    return spark.read.parquet(f"{root}/gold/demand_predictions")


@register("demand_forecast_keys", _AHEAD_SQL)
def demand_forecast_keys(spark: SparkSession, base: str) -> DataFrame:
    """R9's rows: every series-month, the next month, label and features as the scored table has them."""
    features, _ = _forecast(spark, base)
    return features.select("store_id", "product_id", "year_month", "label", "lag_1", "lag_2", "lag_3", "rolling_mean_3")


@register("demand_model_optimality", "SELECT unnest(['intercept', 'lag_1', 'lag_2', 'lag_3', 'rolling_mean_3', 'month_of_year']) AS coefficient, true AS optimal FROM (SELECT count(*) FROM lineitem)")
def demand_model_optimality(spark: SparkSession, base: str) -> DataFrame:
    """Every coefficient of the fitted model meets the elastic net's optimality condition on the whole training table."""
    features, _ = _forecast(spark, base)
    return fc.optimality(fc.train_demand_model(features), features)


_KNOWN = " AND ".join(f"{c} IS NOT NULL" for c in ("label", *fc.FEATURES))
_TRAINING_SQL = f"(SELECT * FROM ({ORACLES['demand_features']}) WHERE {_KNOWN})"


@register("demand_folds", f"""
WITH m AS (SELECT year_month, month_index, count(*) AS "rows", row_number() OVER (ORDER BY month_index) - 1 AS pos, count(*) OVER () AS t
           FROM {_TRAINING_SQL} GROUP BY year_month, month_index),
f AS (SELECT *, t // (least({mc.FOLDS}, t - 1) + 1) AS w, least({mc.FOLDS}, t - 1) AS n FROM m),
k AS (SELECT *, unnest(range(1, n + 1)) AS fold FROM f)
SELECT CAST(fold AS INTEGER) AS fold, CASE WHEN pos < t - (n - fold + 1) * w THEN 'train' ELSE 'validate' END AS role, year_month, "rows"
FROM k WHERE pos < t - (n - fold) * w""")
def demand_folds(spark: SparkSession, base: str) -> DataFrame:
    """The months each time-ordered fold trains on and validates; none trains on a month after its validation months."""
    return mc.fold_months(demand_features(spark, base))


def _registered(spark: SparkSession, base: str) -> tuple[DataFrame, str]:
    """Features, and a registry with two versions: the reference parameters, then those chosen on the folds (promoted)."""
    features, root = _forecast(spark, base)
    reg.register_model(fc.train_demand_model(features), root, "demand", features, {"alpha": 0.5, "l1_ratio": 0.2})
    chosen, _ = mc.choose(spark, features, alphas=(5.0,), l1_ratios=(0.2,))
    model = fc.train_demand_model(features, chosen["alpha"], chosen["l1_ratio"])
    reg.promote_model(spark, root, "demand", 1)
    reg.promote_model(spark, root, "demand", reg.register_model(model, root, "demand", features, chosen, chosen["rmse"]))
    return features, root


_CENTS = " || '|' || ".join(f"CAST(sum(CAST(round({c} * 100) AS DECIMAL(38,0))) AS VARCHAR)" for c in ("label", *fc.FEATURES))


@register("demand_model_table", f"""
SELECT 'demand' AS name, version, alpha, 0.2::DOUBLE AS l1_ratio, n AS training_rows, a AS first_month, b AS last_month, md5(n || '|' || a || '|' || b || '|' || s) AS fingerprint,
       version = 2 AS has_error, version = 2 AS promoted
FROM (SELECT count(*) AS n, min(year_month) AS a, max(year_month) AS b, {_CENTS} AS s FROM {_TRAINING_SQL}),
     (SELECT * FROM (VALUES (1, 0.5::DOUBLE), (2, 5.0::DOUBLE)) v(version, alpha))""")
def demand_model_table(spark: SparkSession, base: str) -> DataFrame:
    """Versions with parameters, training rows and their fingerprint; the newest promotion holds."""
    _, root = _registered(spark, base)
    return reg.model_table(spark, root, "demand").select("name", "version", "alpha", "l1_ratio", "training_rows", "first_month", "last_month", "fingerprint",
                                                         F.col("rmse").isNotNull().alias("has_error"), "promoted")


@register("demand_predictions", f"""
SELECT store_id, product_id, year_month, 2 AS model_version,
       CASE WHEN lag_1 IS NULL THEN 'lag_1 unknown' WHEN lag_2 IS NULL THEN 'lag_2 unknown' WHEN lag_3 IS NULL THEN 'lag_3 unknown'
            WHEN rolling_mean_3 IS NULL THEN 'rolling_mean_3 unknown' END AS reason,
       CASE WHEN lag_1 IS NOT NULL AND lag_2 IS NOT NULL AND lag_3 IS NOT NULL AND rolling_mean_3 IS NOT NULL THEN true END AS equals_the_formula
FROM ({_AHEAD_SQL})""")
def demand_predictions(spark: SparkSession, base: str) -> DataFrame:
    """Every stored prediction names its version and equals intercept plus coefficients times features of that
    version's row in the model table."""
    features, root = _registered(spark, base)
    fc.write_predictions(reg.predict_promoted(features, root, "demand"), f"{root}/gold/demand_predictions")
    stored = read_path(spark, f"{root}/gold/demand_predictions")
    weights = F.broadcast(reg.model_table(spark, root, "demand").select(F.col("version").alias("model_version"), "intercept", "coefficients"))  # a row a version
    keys = ["store_id", "product_id", "year_month"]
    value = F.col("intercept")
    for c in fc.FEATURES:
        value = value + F.element_at("coefficients", c) * F.col(c)
    same = F.abs(F.col("prediction") - value) <= 1e-9 * F.greatest(F.lit(1.0), F.abs(value))
    return stored.join(features.select(*keys, *fc.FEATURES), keys).join(weights, "model_version").select(
        *keys, "model_version", "reason", same.alias("equals_the_formula"))


@register("upsert_orders_by_month", _ORDERS_MERGE_SQL)
def upsert_orders_by_month(spark: SparkSession, base: str) -> DataFrame:
    """D2 with an order-month layout: the change batch rewrites only the
    months it touches."""
    path = scratch_path(spark, "silver_orders_monthly")
    month = F.date_format("o_orderdate", "yyyyMM")
    up.upsert_table(fx.orders_initial(spark, base), path, ["o_orderkey"], layout=month)
    info = up.upsert_table(fx.orders_changes(spark, base), path, ["o_orderkey"], layout=month)
    assert info["mode"] == "merge"
    return spark.read.parquet(path).drop(up.BUCKET)


@register("upsert_bucket_local", _ORDERS_MERGE_SQL)
def upsert_bucket_local(spark: SparkSession, base: str) -> DataFrame:
    """D1/J3 with a batch beyond the broadcast bound: merged by groups of buckets, the stored rows never shuffled; then replayed."""
    path = scratch_path(spark, "silver_orders_groups")
    up.upsert_table(fx.orders_initial(spark, base), path, ["o_orderkey"], buckets=8)
    bound = max(1, fx.orders_changes(spark, base).count() // 4)
    for _ in range(2):
        assert up.upsert_table(fx.orders_changes(spark, base), path, ["o_orderkey"], max_broadcast_rows=bound)["groups"] > 1
    return spark.read.parquet(path).drop(up.BUCKET)


@register("upsert_foreign_table", _ORDERS_MERGE_SQL)
def upsert_foreign_table(spark: SparkSession, base: str) -> DataFrame:
    """Orders first written as plain parquet by something else; the upsert takes the table over."""
    path = scratch_path(spark, "silver_orders_foreign")
    fx.orders_initial(spark, base).write.parquet(path)
    assert up.upsert_table(fx.orders_changes(spark, base), path, ["o_orderkey"], buckets=16)["mode"] == "taken over"
    up.upsert_table(fx.orders_changes(spark, base), path, ["o_orderkey"])
    return spark.read.parquet(path).drop(up.BUCKET)


@register("upsert_padded_layout", _ORDERS_MERGE_SQL)
def upsert_padded_layout(spark: SparkSession, base: str) -> DataFrame:
    """D2 with a zero-padded month text as layout: ``01`` stays ``01``."""
    return _upsert_by(spark, base, "silver_orders_padded", F.date_format("o_orderdate", "MM"))


@register("upsert_null_layout", _ORDERS_MERGE_SQL)
def upsert_null_layout(spark: SparkSession, base: str) -> DataFrame:
    """D2 with null and non-null layout values in one batch."""
    layout = F.when(F.col("o_orderkey") % 5 > 0, F.date_format("o_orderdate", "yyyy"))
    return _upsert_by(spark, base, "silver_orders_null_layout", layout)


def _upsert_by(spark: SparkSession, base: str, name: str, layout) -> DataFrame:
    path = scratch_path(spark, name)
    for batch in (fx.orders_initial(spark, base), fx.orders_changes(spark, base), fx.orders_changes(spark, base)):
        up.upsert_table(batch, path, ["o_orderkey"], layout=layout)
    return spark.read.parquet(path).drop(up.BUCKET)


def _scan_table_sql(table: str, columns: tuple[str, ...]) -> str:
    parts = [
        f"SELECT '{c}' AS column_name, '{name}' AS pattern, count({c}) AS n_values, "
        f"count_if(regexp_matches({c}, '{pat}')) AS n_flagged FROM {table}"
        for c in columns for name, pat in gv.SENSITIVE_PATTERNS.items()
    ]
    return ("SELECT *, CASE WHEN n_values > 0 THEN CAST(n_flagged AS DOUBLE) / n_values END AS flagged_share FROM ("
            + "\nUNION ALL\n".join(parts) + ")")


@register("sensitive_scan_pages", _scan_table_sql("pages", ("url", "html")))
def sensitive_scan_pages(spark: SparkSession, base: str) -> DataFrame:
    return gv.sensitive_scan(read_table(spark, base, "pages"), ["url", "html"])


@register("sensitive_scan_conversations", _scan_table_sql("conversations", ("role", "text")))
def sensitive_scan_conversations(spark: SparkSession, base: str) -> DataFrame:
    return gv.sensitive_scan(read_table(spark, base, "conversations"), ["role", "text"])
