"""Silver-shaped views derived from the input tables.

The input tables are clean, so the nulls, orphans, repeats and bad values the
operators must handle are derived here by fixed rules on the key columns. The
same rules are written as SQL in ``stratum.oracles`` for the DuckDB oracle.
Every view reads its whole source tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.expressions import date_key_of
from stratum.sources.tables import read_table

# --- fixed derivation rules ---
ORPHAN_PART_SIZE = 45           # parts above this size carry a negated product_id
NULL_LAST_NAME_EVERY = 50       # customer_id % 50 = 0 -> last_name null
BAD_EMAIL_EVERY = 200           # customer_id % 200 = 0 -> 'bad-<id>'
NULL_EMAIL_REMAINDER = (333, 1)  # customer_id % 333 = 1 -> email null
EVENT_COPY_EVERY = 10           # event_id % 10 = 0 -> exact copy delivered again
EVENT_VERSION_EVERY = 7         # event_id % 7 = 0 -> newer version (+1, one hour later)
EVENT_BAD_VALUE_EVERY = 101     # event_id % 101 = 0 -> value '12x'
EVENT_BATCH_SPLIT = "2024-01-16 00:00:00.000000"
ORDER_UPDATE_FROM = "2000-01-01"  # orders re-sent from this date carry a new status
ORDER_INITIAL_BEFORE = "2000-07-01"  # the first Silver load holds orders before this date
TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
HOT_ORDER_EVERY = 3             # l_orderkey % 3 = 0 -> the line is sold to the hot customer and product
HOT_CUSTOMER = 1                # repeated in customers_dirty, so its sales also fan out
HOT_PRODUCT = 1                 # a part that keeps its id in products_conformed at every scale
# --- end of fixed derivation rules ---


def _region_code(r_name: Column) -> Column:
    return (
        F.when(r_name == "AMERICA", "NA")
        .when(r_name == "ASIA", "APAC")
        .when(r_name.isin("AFRICA", "EUROPE", "MIDDLE EAST"), "EMEA")
    )


def transactions_cleansed(spark: SparkSession, base: str, with_source_file: bool = False) -> DataFrame:
    """One row per order line: ``transaction_id, date_key, customer_id,
    product_id, store_id, quantity, unit_price`` (plus ``_source_file``, the
    line-item file the row was read from, when asked)."""
    return _transactions(spark, base, with_source_file, hot=False)


def transactions_hot(spark: SparkSession, base: str) -> DataFrame:
    """``transactions_cleansed`` with two hot keys: every line of an order
    whose key is a multiple of ``HOT_ORDER_EVERY`` (about a third of all
    lines) is sold to ``HOT_CUSTOMER`` and is of ``HOT_PRODUCT``. Every line
    is kept; only the two key columns change."""
    return _transactions(spark, base, with_source_file=False, hot=True)


def _transactions(spark: SparkSession, base: str, with_source_file: bool, hot: bool) -> DataFrame:
    li = read_table(spark, base, "lineitem")
    extra = []
    if with_source_file:
        li = li.withColumn("_source_file", F.col("_metadata.file_path"))
        extra = [F.col("_source_file")]
    orders = read_table(spark, base, "orders").select("o_orderkey", "o_custkey")
    txn_id = F.concat_ws(
        "-", *(F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    )
    customer, product = F.col("o_custkey"), F.col("l_partkey")
    if hot:
        is_hot = F.col("l_orderkey") % HOT_ORDER_EVERY == 0
        customer = F.when(is_hot, F.lit(HOT_CUSTOMER).cast("bigint")).otherwise(customer)
        product = F.when(is_hot, F.lit(HOT_PRODUCT).cast("bigint")).otherwise(product)
    return li.join(orders, li.l_orderkey == orders.o_orderkey).select(
        txn_id.alias("transaction_id"),
        date_key_of(F.col("l_shipdate")).alias("date_key"),
        customer.alias("customer_id"),
        product.alias("product_id"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        *extra,
    )


def products_conformed(spark: SparkSession, base: str) -> DataFrame:
    """``product_id, standard_cost`` of every part; large parts carry another (negated) id on purpose, so
    that some sales have no product (null margin)."""
    key = F.when(F.col("p_size") <= ORPHAN_PART_SIZE, F.col("p_partkey")).otherwise(-F.col("p_partkey"))
    return read_table(spark, base, "part").select(key.alias("product_id"), F.col("p_retailprice").alias("standard_cost"))


def customers_conformed(spark: SparkSession, base: str) -> DataFrame:
    """``customer_id, first_name, last_name, email, segment, region, is_active``."""
    c = read_table(spark, base, "customer")
    # nation (25 rows) and region (5 rows) have a fixed size at every scale
    n = F.broadcast(read_table(spark, base, "nation").select("n_nationkey", "n_regionkey"))
    r = F.broadcast(read_table(spark, base, "region").select("r_regionkey", "r_name"))
    cid = F.col("c_custkey")
    email = (
        F.when(cid % NULL_EMAIL_REMAINDER[0] == NULL_EMAIL_REMAINDER[1], F.lit(None).cast("string"))
        .when(cid % BAD_EMAIL_EVERY == 0, F.concat(F.lit("bad-"), cid.cast("string")))
        .otherwise(F.concat(F.lit("c"), cid.cast("string"), F.lit("@example.com")))
    )
    return (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            cid.alias("customer_id"),
            F.substring_index("c_name", "#", 1).alias("first_name"),
            F.when(cid % NULL_LAST_NAME_EVERY == 0, F.lit(None).cast("string"))
            .otherwise(F.substring_index("c_name", "#", -1)).alias("last_name"),
            email.alias("email"),
            F.col("c_mktsegment").alias("segment"),
            _region_code(F.col("r_name")).alias("region"),
            (F.col("c_acctbal") > 0).alias("is_active"),
        )
    )


def customers_dirty(spark: SparkSession, base: str) -> DataFrame:
    """Customers that break every rule of the customer contract: ids below 10
    delivered twice, one row with a null id, region 'MARS' on every 100th id
    and a malformed e-mail on every 20th."""
    cid = F.col("customer_id")
    spoiled = customers_conformed(spark, base).select(
        cid,
        "first_name",
        "last_name",
        F.when(cid % 20 == 0, F.concat(F.lit("c"), cid.cast("string"), F.lit("@@example")))
        .otherwise(F.col("email")).alias("email"),
        "segment",
        F.when(cid % 100 == 0, F.lit("MARS")).otherwise(F.col("region")).alias("region"),
        "is_active",
    )
    repeats = spoiled.where(cid < 10)
    null_id = spoiled.where(cid == 1).withColumn("customer_id", F.lit(None).cast("bigint"))
    return spoiled.unionByName(repeats).unionByName(null_id)


def events_bronze(spark: SparkSession, base: str) -> DataFrame:
    """Raw event deliveries, every column a string: ``id, name, value,
    updated_at, extra``. Holds exact re-deliveries, newer versions and
    unparseable values."""
    ev = read_table(spark, base, "events")
    eid = F.col("event_id")
    money = F.col("value").cast("decimal(18,2)")
    value = F.when(eid % EVENT_BAD_VALUE_EVERY == 0, F.lit("12x")).otherwise(money.cast("string"))

    def rows(val: Column, ts: Column) -> list[Column]:
        return [
            eid.cast("string").alias("id"),
            F.col("event_type").alias("name"),
            val.alias("value"),
            F.date_format(ts, TS_FORMAT).alias("updated_at"),
            F.col("props").alias("extra"),
        ]

    first = ev.select(*rows(value, F.col("ts")))
    copies = ev.where(eid % EVENT_COPY_EVERY == 0).select(*rows(value, F.col("ts")))
    versions = ev.where(eid % EVENT_VERSION_EVERY == 0).select(
        *rows((money + 1).cast("string"), F.col("ts") + F.expr("INTERVAL 1 HOUR"))
    )
    return first.unionByName(copies).unionByName(versions)


def events_batch(spark: SparkSession, base: str, which: int) -> DataFrame:
    """Two arrival batches of ``events_bronze`` split by ``updated_at``; the
    second also holds newer versions of some ids of the first."""
    bronze = events_bronze(spark, base)
    if which == 1:
        return bronze.where(F.col("updated_at") < EVENT_BATCH_SPLIT)
    return bronze.where(F.col("updated_at") >= EVENT_BATCH_SPLIT)


def orders_initial(spark: SparkSession, base: str) -> DataFrame:
    """First Silver load of orders: everything ordered before the cut date."""
    return read_table(spark, base, "orders").where(F.col("o_orderdate") < F.lit(ORDER_INITIAL_BEFORE).cast("timestamp_ntz"))


def orders_changes(spark: SparkSession, base: str) -> DataFrame:
    """A change batch: recent orders re-sent with a new status (updates for
    those already loaded, inserts for the rest)."""
    o = read_table(spark, base, "orders")
    new_status = F.when(F.col("o_orderstatus") == "O", "F").otherwise(F.lit("P"))
    return o.where(F.col("o_orderdate") >= F.lit(ORDER_UPDATE_FROM).cast("timestamp_ntz")).select(
        *[new_status.alias(c) if c == "o_orderstatus" else F.col(c) for c in o.columns]
    )


def coarse_keys(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """Store → nation and product → brand maps for the coarse monthly grain."""
    stores = read_table(spark, base, "supplier").select(
        F.col("s_suppkey").alias("store_id"), F.col("s_nationkey").alias("store_nation")
    )
    brands = read_table(spark, base, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("product_brand")
    )
    return stores, brands
