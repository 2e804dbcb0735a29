"""Incremental Gold job: only the days whose inputs changed are rebuilt, and the months they belong to.

What a run found is kept beside the Gold tables (``_incremental/run=<n>``): a fingerprint of every sales day, of every
product and of the customers that repeat. The next run compares: a day changed when its
sales did, when a product sold on it did (another cost, gone, new) or when a customer who bought on it now repeats
otherwise. The fact's changed days and the aggregate's touched months are then rewritten with dynamic partition
overwrites; days and months that lost all their rows are dropped.

Fingerprints are sums over row hashes, so they cost one partially aggregated scan without a shuffle of rows. A run's state
is marked complete last: a run that dies is repeated by the next one, over the same days or more.
"""

from __future__ import annotations

import logging
import uuid
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.expressions import year_month_of
from stratum.operators import contracts as ct
from stratum.operators import governance as gv
from stratum.operators.gold import FACT_KEYS, build_customer_dimension, build_monthly_sales_aggregate
from stratum.operators.joins import at_most, skew_join
from stratum.plans.pipelines import GoldInputs, gold_inputs, run_timestamp, write_lineage
from stratum.session import checkpoint_root
from stratum.sources import fs
from stratum.sources.lake import LakeConfig, read_path, write_table

log = logging.getLogger(__name__)

STATE = "_incremental"
DONE = "_DONE"
KEPT_STATES = 2
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def fingerprint(rows: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, rows, mixed, total): per key the number of rows, the exclusive or and the sum of their hashes.

    The same rows in any order give the same values; the sum keeps two equal rows from cancelling out."""
    h = F.xxhash64(*[F.col(c) for c in columns])
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), F.bit_xor(h).alias("mixed"), F.sum(h.cast("decimal(20,0)")).alias("total"))


def changed_keys(now: DataFrame, before: DataFrame, key: str) -> DataFrame:
    """Keys whose fingerprint differs, or that only one side has. Null keys compare as equal."""
    measures = [c for c in now.columns if c != key]
    a = now.select(F.struct(key).alias("k"), F.struct(*measures).alias("now"))
    b = before.select(F.struct(key).alias("k"), F.struct(*measures).alias("before"))
    return a.join(b, "k", "full").where(~F.col("now").eqNullSafe(F.col("before"))).select(F.col(f"k.{key}").alias(key))


def day_of(column: str = "date_key") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _states(spark: SparkSession, root: str) -> list[str]:
    """Folders of complete states, oldest first."""
    runs = [d for d in fs.list_dirs(spark, root) if d.rsplit("/", 1)[-1].startswith("run=")]
    return sorted(d for d in runs if fs.exists(spark, f"{d}/{DONE}"))


def _fingerprints(inputs: GoldInputs, carry: Sequence[str]) -> dict[str, DataFrame]:
    sales = inputs.sales.withColumn("date_key", day_of())
    repeated = inputs.customers.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)
    if inputs.keys_unique:
        repeated = repeated.where(F.lit(False))
    return {
        "days": fingerprint(sales, "date_key", [*FACT_KEYS, *carry]),
        "products": fingerprint(inputs.products, "product_id", ["standard_cost"]),
        "repeated_customers": repeated,
        "dimension": fingerprint(inputs.customers.withColumn("one", F.lit(1)), "one", inputs.customers.columns),
    }


def changed_days(inputs: GoldInputs, now: dict[str, DataFrame], before: dict[str, DataFrame]) -> list[str]:
    """The days to rebuild, at most one entry a day of the fact."""
    days = changed_keys(now["days"], before["days"], "date_key")
    for table, key in (("products", "product_id"), ("repeated_customers", "customer_id")):
        keys = changed_keys(now[table], before[table], key).where(F.col(key).isNotNull()).checkpoint()
        if not at_most(keys, 0):
            sold = skew_join(inputs.sales.select(day_of().alias("date_key"), key), keys, key, "inner")
            days = days.unionByName(sold.select("date_key"))
    return sorted(r.date_key for r in days.distinct().collect())


def _drop_partitions(spark: SparkSession, path: str, column: str, values: Sequence[str]) -> None:
    for v in values:
        fs.delete(spark, f"{path}/{column}={v or NULL_FOLDER}")


def silver_to_gold_incremental(spark: SparkSession, config: LakeConfig, customer_contract: Sequence[ct.Expectation] | None = None,
                               lineage: bool = False, history_path: str | None = None) -> dict:
    """L5 by changed days: ``fact_sales`` (a partition a day), ``agg_monthly_sales`` (a partition a month) and ``dim_customer``.

    Equal to a full rebuild from the Silver tables as they are. The first run builds everything. Returns the paths, the days and
    months rewritten and whether the dimension was. ``lineage`` writes the lineage tables too, for the same months; whether it is on
    must not change between runs of one Gold layer. Gold tables are plain files here: a table format with its own
    transactions has its own change feed.
    """
    if config.format != "parquet":
        raise ValueError("the incremental Gold job writes parquet partitions")
    checkpoint_root(spark)
    root = config.gold(STATE)
    done = _states(spark, root)
    carry = [gv.FILE_ID] if lineage else []
    inputs = gold_inputs(spark, config, customer_contract, lineage, history_path)
    at = run_timestamp()
    now = {t: df.checkpoint() for t, df in _fingerprints(inputs, carry).items()}
    sold = {r.date_key: r.rows for r in now["days"].select("date_key", "rows").collect()}
    known = sorted(sold)
    first = not done
    if first:
        days, gone, new_dim = known, [], True
    else:
        before = {t: spark.read.parquet(f"{done[-1]}/{t}") for t in now}
        days = changed_days(inputs, now, before)
        gone = sorted(set(days) - set(known))
        new_dim = not at_most(changed_keys(now["dimension"], before["dimension"], "one"), 0)
    if new_dim:
        write_table(build_customer_dimension(inputs.customers, at), config.gold("dim_customer"))

    fact_path, agg_path = config.gold("fact_sales"), config.gold("agg_monthly_sales")
    months = sorted({d[:6] for d in days})
    rebuilt = sorted(set(days) - set(gone))
    sales = inputs.sales if first else inputs.sales.where(day_of().isin(rebuilt))
    fact = inputs.fact(sales, at, carry, ["date_key"])
    paths = {"dim_customer": config.gold("dim_customer"), "fact_sales": fact_path, "agg_monthly_sales": agg_path}
    if rebuilt or first:
        write_table(fact, fact_path, partition_cols=["date_key"], only_partitions=not first, rebalance=False)
    _drop_partitions(spark, fact_path, "date_key", gone)
    if months or first:
        # the touched months whole, from the written fact; the partition filter prunes the others
        touched = read_path(spark, fact_path, schema=fact.schema)
        if not first:
            touched = touched.where(F.coalesce(year_month_of(), F.lit("")).isin(months))
        month_rows = Counter()
        for d, n in sold.items():
            month_rows[d[:6]] += n
        agg = build_monthly_sales_aggregate(touched, month_rows=month_rows).withColumn("dw_inserted_at", at)
        write_table(agg, agg_path, partition_cols=["year_month"], only_partitions=not first, rebalance=False)
        left = {d[:6] for d in known}
        _drop_partitions(spark, agg_path, "year_month", [m for m in months if m not in left])
        if lineage:
            paths |= write_lineage(spark, config, touched, uuid.uuid4().hex, only_months=not first)
            _drop_partitions(spark, paths["lineage_rows"], "year_month", [m for m in months if m not in left])

    number = int(done[-1].rsplit("=", 1)[1]) + 1 if done else 1
    state = f"{root}/run={number:08d}"
    fs.delete(spark, state)  # of a run that died before its mark
    for table, df in now.items():
        df.write.parquet(f"{state}/{table}")
    fs.write_text(spark, f"{state}/{DONE}", "complete")
    for old in done[:len(done) + 1 - KEPT_STATES]:
        fs.delete(spark, old)
    log.info("Gold: %d of %d days, %d months rebuilt", len(rebuilt), len(known), len(months))
    return {"paths": paths, "days": rebuilt, "dropped_days": gone, "months": months, "dimension": new_dim}


def read_monthly(spark: SparkSession, config: LakeConfig) -> DataFrame:
    """The aggregate table with ``year_month`` as a text."""
    path = config.gold("agg_monthly_sales")
    kept = spark.read.parquet(path).schema
    return spark.read.schema(", ".join(
        f"`{f.name}` {'string' if f.name == 'year_month' else f.dataType.simpleString()}" for f in kept.fields)).parquet(path)
