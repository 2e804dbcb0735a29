"""Composite layer jobs: Bronze → Silver (L1) and Silver → Gold (L5), with
optional contract gates before promotion (R10)."""

from __future__ import annotations

import logging
import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stratum.operators import contracts as ct
from stratum.operators import governance as gv
from stratum.operators.conform import clean, enforce_schema, stamp
from stratum.operators.gold import build_customer_dimension, build_monthly_sales_aggregate, build_sales_fact
from stratum.operators.upsert import has_layout, upsert_table
from stratum.session import checkpoint_root
from stratum.sources import fs
from stratum.sources.lake import LakeConfig, read_layer_table, read_path, write_table

log = logging.getLogger(__name__)


def run_timestamp() -> Column:
    """One literal per run, so every table written by the run agrees."""
    return F.lit(datetime.now(timezone.utc)).cast("timestamp")


BUCKET_BYTES = 256 << 20


def default_buckets(spark: SparkSession, path: str) -> int:
    """Bucket count of a Silver table whose creator names none: one for each 256 MB of the first load's files, so that the
    table can grow fourfold before a bucket passes 1 GB. Name ``buckets`` for a table that will grow further."""
    return max(1, math.ceil(fs.size(spark, path) / BUCKET_BYTES))


def bronze_to_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    schema: StructType | None = None,
    keys: Sequence[str] = ("id",),
    dedup_keys: Sequence[str] = ("id", "updated_at"),
    order_by: Sequence[str] = ("updated_at",),
    contract: Sequence[ct.Expectation] | None = None,
    cast_mode: str = "permissive",
    bronze_format: str = "parquet",
    keep_audit: bool = True,
    buckets: int | None = None,
    guard: str | None = None,
    silver_format: str = "parquet",
    quarantine_path: str | None = None,
    history_path: str | None = None,
    run_id: str | None = None,
) -> dict:
    """L1: read Bronze, clean (stamp + exact dedup), enforce the schema,
    check the contract, then upsert into Silver by ``keys`` (initial load when
    Silver is absent).

    Differences from the original, on purpose: several versions of one key
    in a batch are reduced to the latest by ``order_by`` before the merge
    (a merge cannot take two), and with ``keep_audit`` the audit column is
    stamped after enforcement so it survives it (Q3, Q5).

    A broken contract halts the run; with ``quarantine_path`` only the good rows are promoted and the
    others are written there with the rules they break (``contracts.split_rows``). ``history_path`` keeps the
    contract's results, one partition a run. ``run_id`` names the run: the same run again replaces its quarantine and results.
    ``silver_format='delta'`` upserts into a Delta table where the Delta package is installed.
    ``buckets`` counts when a parquet table is created (default: by the size of Bronze).
    """
    at = run_timestamp()
    run_id = run_id or uuid.uuid4().hex
    log.info("reading Bronze %s", bronze_path)
    df = clean(read_path(spark, bronze_path, bronze_format), dedup_keys, at=at)
    if schema is not None:
        df = enforce_schema(df, schema, cast_mode)
        if keep_audit:
            df = stamp(df, at=at)
    split: dict = {}
    if contract and quarantine_path:
        df, split = ct.promote(df, contract, quarantine_path, "bronze_to_silver", silver_path, run_id, history_path)
    elif contract:
        # the gate and the upsert both read the cleaned batch: compute it once
        checkpoint_root(spark)
        df = df.checkpoint()
        ct.gate(df, contract, suite="bronze_to_silver", asset=silver_path, history_path=history_path, run_id=run_id)
    log.info("upserting into Silver %s", silver_path)
    if silver_format == "parquet" and buckets is None and not has_layout(spark, silver_path):
        buckets = default_buckets(spark, bronze_path)
    info = upsert_table(df, silver_path, keys, buckets=buckets, on_duplicate="latest", order_by=order_by, guard=guard, fmt=silver_format)
    return info | split


GOLD_PROCESSES = (
    ("silver_to_gold.sales_fact", "silver.transactions_cleansed", "gold.fact_sales"),
    ("silver_to_gold.sales_fact", "silver.customers_conformed", "gold.fact_sales"),
    ("silver_to_gold.sales_fact", "silver.products_conformed", "gold.fact_sales"),
    ("silver_to_gold.customer_dimension", "silver.customers_conformed", "gold.dim_customer"),
    ("silver_to_gold.monthly_sales", "gold.fact_sales", "gold.agg_monthly_sales"),
)
LINEAGE_VERSION = "v1"
#: The edge that the lineage rows stand for: transactions that reached a Gold group.
ROW_PROCESS = GOLD_PROCESSES[0]


@dataclass(frozen=True)
class GoldInputs:
    """The Silver tables of a Gold run, and whether the contract proved customer_id unique."""

    sales: DataFrame
    customers: DataFrame
    products: DataFrame
    keys_unique: bool

    def fact(self, sales: DataFrame, at: Column, carry: Sequence[str] = (), cluster: Sequence[str] = ()) -> DataFrame:
        # with customer_id proven unique the customer join cannot repeat a sale
        # and contributes no column, so it is dropped (same rows, no join)
        return build_sales_fact(sales, None if self.keys_unique else self.customers, self.products, at, carry=carry, cluster=cluster)


def gold_inputs(spark: SparkSession, config: LakeConfig, customer_contract: Sequence[ct.Expectation] | None = None,
                lineage: bool = False, history_path: str | None = None) -> GoldInputs:
    """Read the Silver tables and gate the customers. With ``lineage`` each sale carries the code of its file."""
    fmt = config.format
    sales = read_layer_table(spark, config.silver_base_path, "transactions_cleansed", fmt)
    if lineage:
        sales = sales.withColumn(gv.FILE_ID, gv.file_id(F.col("_metadata.file_path")))
    customers = read_layer_table(spark, config.silver_base_path, "customers_conformed", fmt)
    products = read_layer_table(spark, config.silver_base_path, "products_conformed", fmt)
    keys_unique = False
    if customer_contract:
        ct.gate(customers, customer_contract, suite="silver_customer_suite", asset="customers_conformed", history_path=history_path)
        keys_unique = any(e.expectation_type == ct.UNIQUE and e.column == "customer_id" and e.mostly == 1.0
                          for e in customer_contract)
    return GoldInputs(sales, customers, products, keys_unique)


def write_lineage(spark: SparkSession, config: LakeConfig, fact: DataFrame, run_id: str, only_months: bool = False) -> dict[str, str]:
    """The three lineage tables, from the fact as written: no join is computed again. Processes are added run by run."""
    fmt = config.format
    names = {t: config.gold(t) for t in ("lineage_files", "lineage_processes", "lineage_rows")}
    source = read_layer_table(spark, config.silver_base_path, "transactions_cleansed", fmt)
    write_table(gv.lineage_files(source), names["lineage_files"], fmt)
    write_table(gv.lineage_processes(spark, GOLD_PROCESSES, LINEAGE_VERSION, run_id), names["lineage_processes"], fmt, mode="append")
    write_table(gv.lineage_rows(fact, ROW_PROCESS, LINEAGE_VERSION), names["lineage_rows"], fmt, partition_cols=["year_month"],
                only_partitions=only_months)
    return names


def read_lineage(spark: SparkSession, config: LakeConfig) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, files, processes) of the Gold layer; ``year_month`` stays a text."""
    rows = spark.read.format(config.format)
    if config.format != "delta":
        found = rows.load(config.gold("lineage_rows")).schema
        rows = spark.read.format(config.format).schema(StructType([
            StructField(f.name, StringType() if f.name == "year_month" else f.dataType) for f in found.fields]))
    return (rows.load(config.gold("lineage_rows")), *(read_path(spark, config.gold(t), config.format) for t in ("lineage_files", "lineage_processes")))


def silver_to_gold(
    spark: SparkSession,
    config: LakeConfig,
    customer_contract: Sequence[ct.Expectation] | None = None,
    fact_partition_cols: Sequence[str] = ("date_key",),
    lineage: bool = False,
    history_path: str | None = None,
) -> dict[str, str]:
    """Dimension, fact and monthly aggregate.

    The fact is written once and the aggregate is built from the written
    table (the original recomputed both joins for the aggregate, Q13); one
    run timestamp is stamped on every table. When the customer contract
    includes a strict uniqueness rule on ``customer_id`` and passes, the
    customer join is skipped: it could only repeat sales of repeated keys.

    ``lineage`` adds the code of each sale's source file to the fact and writes the three
    lineage tables from the written fact (``write_lineage``). ``history_path`` keeps the contract's results.
    """
    fmt = config.format
    inputs = gold_inputs(spark, config, customer_contract, lineage, history_path)
    at = run_timestamp()
    dim = build_customer_dimension(inputs.customers, at)
    fact = inputs.fact(inputs.sales, at, [gv.FILE_ID] if lineage else [], fact_partition_cols)
    write_table(dim, config.gold("dim_customer"), fmt)
    write_table(fact, config.gold("fact_sales"), fmt, partition_cols=list(fact_partition_cols), rebalance=False)
    written = read_path(spark, config.gold("fact_sales"), fmt, schema=fact.schema)
    write_table(build_monthly_sales_aggregate(written), config.gold("agg_monthly_sales"), fmt)
    out = {t: config.gold(t) for t in ("dim_customer", "fact_sales", "agg_monthly_sales")}
    return out | (write_lineage(spark, config, written, uuid.uuid4().hex) if lineage else {})
