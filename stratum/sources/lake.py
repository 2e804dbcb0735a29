"""Layer storage: configuration, named table reads and Gold writes.

Tables are addressed by ``<layer base path>/<table name>``. The format is a
parameter: ``parquet`` by default; ``delta`` works where the Delta jar is on
the classpath (it is not in the test image, so that branch is untested here).
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratum.sources import fs

log = logging.getLogger(__name__)

COMPRESSION = "zstd"


@dataclass(frozen=True)
class LakeConfig:
    """Where the layers live (S3: both Silver and Gold bases are required)."""

    silver_base_path: str
    gold_base_path: str
    bronze_base_path: str | None = None
    format: str = "parquet"

    REQUIRED = ("silver_base_path", "gold_base_path")

    def __post_init__(self) -> None:
        for key in self.REQUIRED:
            if not getattr(self, key):
                raise ValueError(f"no {key} given; the lake needs a base path for Silver and for Gold")

    @classmethod
    def from_mapping(cls, conf: Mapping[str, str]) -> LakeConfig:
        for key in cls.REQUIRED:
            if key not in conf:
                raise ValueError(f"no {key} given; the lake needs a base path for Silver and for Gold")
        fields = {k: conf[k] for k in ("silver_base_path", "gold_base_path", "bronze_base_path", "format") if k in conf}
        return cls(**fields)

    def silver(self, table: str) -> str:
        return f"{self.silver_base_path.rstrip('/')}/{table}"

    def gold(self, table: str) -> str:
        return f"{self.gold_base_path.rstrip('/')}/{table}"

    def bronze(self, table: str) -> str:
        if not self.bronze_base_path:
            raise ValueError("Configuration has no 'bronze_base_path'")
        return f"{self.bronze_base_path.rstrip('/')}/{table}"


def read_path(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """Whole-table scan at a path (S1, S8). A schema, when given, is applied
    at read time, which also fixes partition-column types (Q9)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_layer_table(spark: SparkSession, base: str, table: str, fmt: str = "parquet",
                     schema: StructType | None = None) -> DataFrame:
    """Named table in a layer (S2); failures are logged and re-raised."""
    path = f"{base.rstrip('/')}/{table}"
    log.info("reading table %r from %s", table, path)
    try:
        return read_path(spark, path, fmt, schema)
    except Exception:
        log.error("failed to read table %r at %s", table, path)
        raise


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Is there a readable table at ``path``?"""
    if fmt == "delta":
        try:
            from delta.tables import DeltaTable  # optional dependency
        except ImportError:
            DeltaTable = None
        if DeltaTable is not None:
            return bool(DeltaTable.isDeltaTable(spark, path))
    if not fs.exists(spark, path):  # the common "first load" case, no exception
        return False
    try:
        spark.read.format(fmt).load(path).schema
        return True
    except AnalysisException:  # a folder without readable data files
        return False


def existing_schema(spark: SparkSession, path: str, fmt: str = "parquet") -> StructType | None:
    """Schema of the table at ``path``, or None when there is none.

    For a partitioned table the schema is read from one partition folder
    (``basePath`` keeps the partition columns), so a large table is not
    listed file by file just to learn its columns; Spark's default schema
    read takes a single file's footer anyway.
    """
    if fmt == "delta" or not fs.exists(spark, path):
        return spark.read.format(fmt).load(path).schema if table_exists(spark, path, fmt) else None
    partitions = [d for d in fs.list_dirs(spark, path) if "=" in d.rsplit("/", 1)[-1]]
    try:
        if partitions:
            return spark.read.format(fmt).option("basePath", path).load(partitions[0]).schema
        return spark.read.format(fmt).load(path).schema
    except AnalysisException:  # a folder without readable data files
        return None


def align_to_existing(df: DataFrame, existing: StructType) -> DataFrame:
    """Schema merge on overwrite (Q8): keep every column of the table being
    replaced, as null where the new data lacks it; new columns are added."""
    have = set(df.columns)
    extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in existing.fields if f.name not in have]
    return df.select(*df.columns, *extra) if extra else df


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_cols: Sequence[str] | None = None,
    merge_schema: bool = True,
    mode: str = "overwrite",
    only_partitions: bool = False,
    rebalance: bool = True,
    compression: str | None = COMPRESSION,
) -> None:
    """Gold sink (S4, S5, S7): overwrite with schema merge, optional partitions.

    For partitioned writes the rows are rebalanced on the partition columns
    first; AQE splits a hot partition value over several tasks and packs
    small ones together, so each value gets a few well-sized files instead of
    one file per task (or one task holding a third of the data).
    ``only_partitions`` overwrites the partitions that ``df`` has rows for and leaves the others. ``rebalance=False`` is for
    rows that lie together by partition already. Parquet files are written with ``compression`` (None: the session's).
    """
    spark = df.sparkSession
    if only_partitions and (not partition_cols or fmt == "delta"):
        raise ValueError("only_partitions needs a partitioned table of plain files")
    existing = existing_schema(spark, path, fmt) if merge_schema and mode == "overwrite" and fmt != "delta" else None
    if existing is not None:
        df = align_to_existing(df, existing)
    if partition_cols and rebalance:
        df = df.hint("rebalance", *partition_cols)
    writer = df.write.format(fmt).mode(mode)
    if mode == "overwrite" and partition_cols:
        # a full overwrite whatever the session says: a cluster-wide 'dynamic'
        # mode would keep old partitions missing from the new data
        writer = writer.option("partitionOverwriteMode", "dynamic" if only_partitions else "static")
    if fmt == "parquet" and compression:
        writer = writer.option("compression", compression)
    if fmt == "delta" and merge_schema:
        writer = writer.option("mergeSchema", "true")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    log.info("writing %s", path)
    try:
        writer.save(path)
    except Exception:
        log.error("failed to write %s", path)
        raise
