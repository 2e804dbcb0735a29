"""Join helpers with an explicit size check before any broadcast.

``join_small`` broadcasts a side only after measuring it (``fits``),
because Catalyst's size estimate for a derived side (an
aggregate, a filtered change batch) is the size of its input. ``skew_join``
adds the other way beyond the bound: a shuffle join with heavy keys salted.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, AtomicType, BinaryType, MapType, NullType, StringType, StructType

# rows of a narrow (key + a few columns) side that may be copied to every
# executor, and the bytes that they may hold
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 64 << 20


def at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has no more than ``max_rows`` rows.

    Either form moves at most one row per task to the final step: the
    existence check (``max_rows == 0``) stops each task at its first row; any
    other bound is a plain count with map-side partial counts. (A
    ``limit(n + 1)`` before the count would pass up to ``n + 1`` rows per
    task through a single-partition exchange – billions of rows into one
    task for a large side on thousands of tasks.)"""
    if max_rows == 0:
        return df.limit(1).count() == 0
    return df.count() <= max_rows


def fits(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` may be broadcast: at most ``max_rows`` rows that hold at most ``max_bytes``.

    Fixed-width columns count 8 bytes a row, texts and binaries their bytes and nested values the bytes
    of their JSON, so a side of few rows with wide keys is not taken for small. One aggregate, one row a task; a side of
    fixed-width columns alone is only counted.
    """
    if max_rows <= 0:
        return at_most(df, 0)
    wide: list[Column] = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StringType, BinaryType)):
            wide.append(F.octet_length(c))
        elif not isinstance(f.dataType, (AtomicType, NullType)):
            wide.append(F.octet_length(F.to_json(F.struct(c))))
    if not wide:
        return at_most(df, min(max_rows, max_bytes // (8 * max(1, len(df.columns)))))
    held = sum((F.coalesce(c, F.lit(0)).cast("long") for c in wide), F.lit(8 * len(df.columns)).cast("long"))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(held).alias("bytes")).first()
    return row["n"] <= max_rows and (row["bytes"] or 0) <= max_bytes


def join_small(
    big: DataFrame,
    small: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Join ``big`` with a side that is usually small.

    The small side is broadcast only after measuring that it is within
    ``max_broadcast_rows`` and the byte bound; beyond that the join is left to Spark (sort-merge,
    with AQE splitting skewed partitions of the big side).
    """
    if fits(small, max_broadcast_rows):
        small = F.broadcast(small)
    return big.join(small, on, how)


_NO_SKETCH = (BinaryType, StructType, ArrayType, MapType)


def heavy_keys_of(df: DataFrame, keys: Sequence[str], min_share: float = 0.01, max_tracked: int = 10_000) -> dict[str, list]:
    """For each key column, the keys holding at least ``min_share`` of its rows with a non-null key.

    One aggregation job over all the key columns: row counts plus a
    frequent-items sketch each (``approx_top_k``, bounded memory per task, partial
    sketches merged). At most ``1 / min_share`` keys of a column can qualify, so the
    collected lists have a proven bound. The sketch's count error is a small
    fraction of the rows (about ``3.5 / max_tracked`` of them), so a key far
    above ``min_share`` – one holding a third of the rows – is always found.
    Only performance depends on the estimate: a missed or spurious key never
    changes a join's result. Keys the sketch cannot take (binary, struct,
    array, map) get no hot list: a plain shuffle join, split by AQE.
    """
    found: dict[str, list] = {k: [] for k in keys}
    known = [k for k in found if not isinstance(df.schema[k].dataType, _NO_SKETCH)]
    if not known:
        return found
    top = max(1, math.floor(1 / min_share))
    stats = df.agg(*[F.count(k).alias(f"n{i}") for i, k in enumerate(known)], *[
        F.call_function("approx_top_k", F.col(k), F.lit(top), F.lit(max(top, max_tracked))).alias(f"top{i}") for i, k in enumerate(known)]).first()
    for i, k in enumerate(known):
        n = stats[f"n{i}"]
        found[k] = [t["item"] for t in stats[f"top{i}"] or [] if n and t["item"] is not None and t["count"] >= min_share * n]
    return found


def heavy_keys(df: DataFrame, key: str, min_share: float = 0.01, max_tracked: int = 10_000) -> list:
    """``heavy_keys_of`` for one key column."""
    return heavy_keys_of(df, [key], min_share, max_tracked)[key]


class HotKeys:
    """Heavy keys of several columns of one frame, found in one job when the first of them is asked for.

    Several joins of a frame share the job; when every dimension is broadcast it never runs."""

    def __init__(self, df: DataFrame, keys: Sequence[str], min_share: float = 0.01):
        self._df, self._keys, self._min_share, self._found = df, tuple(keys), min_share, None

    def __getitem__(self, key: str) -> list:
        if self._found is None:
            self._found = heavy_keys_of(self._df, self._keys, self._min_share)
        return self._found[key]


def skew_join(
    big: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "left",
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    salts: int | None = None,
    min_share: float = 0.01,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Join a large table with a dimension on one key, safe for hot keys.

    * dimension within ``max_broadcast_rows`` and the byte bound (``fits``): broadcast hash join;
    * otherwise one shuffle join in which every heavy key of ``big`` (see
      ``heavy_keys_of``) is spread over ``salts`` partitions (default: as many as
      ``spark.sql.shuffle.partitions``, so that no share of the rows is too much for its tasks; a heavy key's few
      dimension rows are replicated as often): its rows get a salt
      from a hash of the row and its partition, and only that key's dimension rows are
      replicated once per salt. Each big row still meets exactly the
      dimension rows of its key, so the result equals the plain join whatever
      the salt. It also keeps a following aggregate from inheriting the join's
      partitioning, so the aggregate shuffles (after a map-side partial step)
      instead of running a hot key's whole group in one task.
    * rows with a null key meet nothing: a left join spreads them by the same salt, so ``big`` is
      evaluated once and no task gets them all; an inner join drops them before the shuffle.

    ``hot`` (default: found on ``big``) is where the heavy keys come from
    – e.g. of the stored input before a join that only
    repeats rows, shared by several joins, so that the estimate does not re-run a join.
    """
    if how not in ("left", "inner"):
        raise ValueError("skew_join supports left and inner joins")
    if fits(dim, max_broadcast_rows):
        return big.join(F.broadcast(dim), key, how)
    heavy = (hot if hot is not None else HotKeys(big, [key], min_share))[key]
    n = salts or int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.col(key).isNull()
    if how == "inner":
        big, spread = big.where(F.col(key).isNotNull()), F.lit(False)
    if heavy:
        spread = spread | F.col(key).isin(heavy)
    # int salts on both sides, so the join keys need no cast. A recomputed task gives its rows the same
    # salts; equal rows spread too, by the partition they are in
    row = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in big.columns])
    salted_big = big.withColumn("_salt", F.when(spread, F.pmod(row, F.lit(n)).cast("int")).otherwise(F.lit(0)))
    fan = F.array(F.lit(0))
    if heavy:
        fan = F.when(F.col(key).isin(heavy), F.sequence(F.lit(0), F.lit(n - 1))).otherwise(fan)
    salted_dim = dim.withColumn("_salt", F.explode(fan))
    return salted_big.join(salted_dim, [key, "_salt"], how).drop("_salt")
