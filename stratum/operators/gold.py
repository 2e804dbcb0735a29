"""Silver → Gold builders: sales fact, customer dimension, monthly aggregate."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.expressions import full_name, money_sum, round2, year_month_of
from stratum.operators.conform import dedup_exact, dedup_latest
from stratum.operators.joins import DEFAULT_BROADCAST_ROWS, HotKeys, at_most, fits, heavy_keys, skew_join
from stratum.session import checkpoint_root

FACT_KEYS = ("transaction_id", "date_key", "customer_id", "product_id", "store_id", "quantity", "unit_price")
#: Sales of a month that are aggregated and written together.
SLOT_ROWS = 250_000
CUSTOMER_COLUMNS = ("customer_id", "first_name", "last_name", "email", "segment", "region", "is_active")


def _inserted_at(at: Column | None) -> Column:
    return (at if at is not None else F.current_timestamp()).alias("dw_inserted_at")


def customer_fanout(sales: DataFrame, customers: DataFrame, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                    hot: HotKeys | None = None) -> DataFrame:
    """Row multiplicity of ``sales LEFT JOIN customers USING (customer_id)``
    when no customer column is kept.

    A sale matching ``m > 1`` customer rows appears ``m`` times; every other
    sale (one match, no match, null key) appears once. Only the repeated
    customer keys, counted with a map-side partial aggregate, are joined back,
    so the fact is not shuffled against the whole customer table; when no
    key repeats (the usual case) there is no join at all. Otherwise the small
    table is checkpointed (to the shared checkpoint folder) so the size check
    and the join read it instead of re-aggregating.
    """
    repeats = (
        customers.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("_copies"))
        .where(F.col("_copies") > 1)
    )
    if at_most(repeats, 0):
        return sales  # no repeated key: the join cannot add or remove a row
    checkpoint_root(customers.sparkSession)
    repeats = repeats.checkpoint()  # computed once for the size check and the join
    joined = skew_join(sales, repeats, "customer_id", "left", max_broadcast_rows, hot=hot)
    copies = F.sequence(F.lit(1), F.coalesce(F.col("_copies"), F.lit(1)).cast("int"))
    return joined.withColumn("_copy", F.explode(copies)).drop("_copies", "_copy")


def build_sales_fact(
    sales: DataFrame,
    customers: DataFrame | None,
    products: DataFrame,
    inserted_at: Column | None = None,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    carry: Sequence[str] = (),
    cluster: Sequence[str] = (),
) -> DataFrame:
    """L3: sales ⟕ customers ⟕ products → fact with two measures.

    ``total_sales_amount = round(quantity * unit_price, 2)``,
    ``margin_amount = round((unit_price - standard_cost) * quantity, 2)``
    (null when the product is unknown). The customer join contributes no
    column but repeats a sale once per duplicate customer row (kept for
    parity); pass ``customers=None`` when the customer key is known unique.
    ``carry`` names extra sales columns passed through (e.g. the source file).
    ``cluster`` rebalances the rows on these columns for a partitioned write, on the columns read only: the measures are
    computed behind the exchange, and the costs too join there when they are broadcast.
    """
    fact = sales.select(*FACT_KEYS, *carry)
    # both joins' heavy keys in one job, before the fan-out, which only repeats rows
    hot = HotKeys(fact, ["customer_id", "product_id"] if customers is not None else ["product_id"])
    if customers is not None:
        fact = customer_fanout(fact, customers.select("customer_id"), max_broadcast_rows, hot)
    # broadcast when counted small; otherwise a shuffle join with hot products
    # salted, so a product holding a third of the sales is not one task
    costs = products.select("product_id", "standard_cost")
    early = bool(cluster) and fits(costs, max_broadcast_rows)
    if early:
        fact = fact.hint("rebalance", *cluster)
    fact = skew_join(fact, costs, "product_id", "left", max_broadcast_rows, hot=hot)
    if cluster and not early:
        fact = fact.hint("rebalance", *cluster)
    return fact.select(
        *FACT_KEYS,
        round2(F.col("quantity") * F.col("unit_price")).alias("total_sales_amount"),
        round2((F.col("unit_price") - F.col("standard_cost")) * F.col("quantity")).alias("margin_amount"),
        _inserted_at(inserted_at),
        *carry,
    )


def build_customer_dimension(customers: DataFrame, inserted_at: Column | None = None,
                             deterministic: bool = True) -> DataFrame:
    """L4: Type 1 customer dimension, one row per ``customer_id``, with
    ``full_name = concat_ws(' ', first_name, last_name)``.

    ``deterministic=True`` keeps the greatest row per key (see
    ``dedup_latest``); ``False`` keeps an arbitrary one, as the original does.
    """
    dim = customers.select(
        *CUSTOMER_COLUMNS[:3], full_name().alias("full_name"), *CUSTOMER_COLUMNS[3:]
    )
    dim = dedup_latest(dim, ["customer_id"]) if deterministic else dedup_exact(dim, ["customer_id"])
    return dim.withColumn("dw_inserted_at", inserted_at if inserted_at is not None else F.current_timestamp())


def build_monthly_sales_aggregate(fact: DataFrame, store_col: str = "store_id",
                                  product_col: str = "product_id", month_rows: Mapping[str, int] | None = None) -> DataFrame:
    """A1: revenue, margin and transaction count per
    ``(year_month, store, product)``; ``year_month`` is the first six
    characters of ``date_key``. Sums skip nulls; the count skips null ids.

    ``month_rows`` (about how many sales each month has) makes one exchange do for the groups and for a write by month: sales
    travel by month and slot, a hash of store and product into one slot for each ``SLOT_ROWS`` sales of the month, so
    a month comes out in that many files and no task gets more of it. Groups that hold a hundredth of the sales or
    more are aggregated in the tasks that read them instead."""
    keys = [year_month_of("date_key").alias("year_month"), F.col(store_col).alias("store_id"), F.col(product_col).alias("product_id")]
    measures = [
        money_sum(F.col("total_sales_amount"), fact.schema["total_sales_amount"].dataType).alias("monthly_revenue"),
        money_sum(F.col("margin_amount"), fact.schema["margin_amount"].dataType).alias("monthly_margin"),
        F.count("transaction_id").alias("transaction_count"),
    ]
    if month_rows is None:
        return fact.groupBy(*keys).agg(*measures)
    known = F.when(F.col("transaction_id").isNotNull(), True).alias("transaction_id")  # only counted
    rows = fact.select(*keys, "total_sales_amount", "margin_amount", known)
    names = ["year_month", "store_id", "product_id"]
    group = F.xxhash64(*names)
    heavy = heavy_keys(rows.select(group.alias("_group")), "_group")
    slots = F.lit(1)
    if wide := {m: math.ceil(n / SLOT_ROWS) for m, n in month_rows.items() if n > SLOT_ROWS}:
        found = F.create_map(*[F.lit(x) for pair in wide.items() for x in pair])
        slots = F.coalesce(F.try_element_at(found, F.col("year_month")), slots)
    dealt = (rows.where(~group.isin(heavy)) if heavy else rows).withColumn("_slot", F.pmod(F.xxhash64("store_id", "product_id"), slots))
    out = dealt.repartition("year_month", "_slot").groupBy(*names, "_slot").agg(*measures).drop("_slot")
    return out.unionByName(rows.where(group.isin(heavy)).groupBy(*names).agg(*measures)) if heavy else out


def coarsen_fact(fact: DataFrame, stores: DataFrame, brands: DataFrame,
                 max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Re-key a fact to a coarser store / product grain through mapping
    tables ``(store_id, store_nation)`` and ``(product_id, product_brand)``."""
    # the first join only adds a column: one job on the fact itself finds the hot keys of both
    hot = HotKeys(fact, ["store_id", "product_id"])
    out = skew_join(fact, stores, "store_id", "left", max_broadcast_rows, hot=hot)
    return skew_join(out, brands, "product_id", "left", max_broadcast_rows, hot=hot)

