"""Bronze → Silver conformance: schema enforcement, audit stamp, dedup.

Dedup is always an aggregation keyed on the dedup keys, never a window: the
partial (map-side) aggregate collapses a hot key inside each task before the
shuffle, so a key holding a third of the rows does not land whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratum.functions.expressions import cast_column

AUDIT_COLUMN = "_processing_timestamp"


def enforce_schema(df: DataFrame, schema: StructType, mode: str = "permissive") -> DataFrame:
    """Keep exactly the schema's columns, in its order, each cast.

    Extra columns are dropped; a missing column raises. Nullability in the
    schema is not enforced here (it is a contract rule, see ``contracts``).
    ``mode='permissive'`` turns unparseable values into null,
    ``mode='strict'`` fails on them.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns required by the schema are missing: {missing}")
    return df.select(*[cast_column(f.name, f.dataType, mode) for f in schema.fields])


def stamp(df: DataFrame, column: str = AUDIT_COLUMN, at: Column | None = None) -> DataFrame:
    """Audit column, one value per query (``current_timestamp()``) unless
    a run timestamp is passed in."""
    return df.withColumn(column, at if at is not None else F.current_timestamp())


def dedup_exact(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A2/A3 as written: one row per key combination; which row survives
    among rows that differ outside the keys is not defined."""
    return df.dropDuplicates(list(keys))


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Deterministic dedup: per key, the row with the greatest ``order_by``
    values; remaining ties are broken by the other columns in schema order,
    so the survivor never depends on partitioning or task order.

    Implemented as ``max(struct(order_by..., others...))`` per key: a hash /
    sort aggregate with a map-side partial step.
    """
    keys = list(keys)
    order_by = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    ranked = order_by + rest
    if not ranked:
        return df.dropDuplicates(keys)
    packed = F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(ranked)])
    top = df.groupBy(*keys).agg(F.max(packed).alias("_top"))
    slot = {c: i for i, c in enumerate(ranked)}
    return top.select(*[F.col(c) if c in keys else F.col(f"_top.f{slot[c]}").alias(c) for c in df.columns])


def clean(df: DataFrame, dedup_keys: Sequence[str] = ("id", "updated_at"), at: Column | None = None) -> DataFrame:
    """L2: stamp, then drop repeated ``dedup_keys`` combinations when every
    key column is present (P5)."""
    df = stamp(df, at=at)
    if all(k in df.columns for k in dedup_keys):
        df = dedup_exact(df, dedup_keys)
    return df
