"""Batch Bronze landing (R1): keep source columns as they arrive, add the
source file and the ingestion time, append.

CSV and JSON files whose columns drift, or whose records are broken, land by name with nothing lost:
``read_json_rescued`` and ``read_csv_rescued`` put what has no column into ``_rescued``.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SOURCE_FILE = "_source_file"
INGESTED_AT = "_ingested_at"
RESCUED = "_rescued"
LANDING_BATCH = "_landing_batch"


def with_landing_columns(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Add ``_source_file`` (from the scan's file metadata) and ``_ingested_at``."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        (at if at is not None else F.current_timestamp()).alias(INGESTED_AT),
    )


def read_json_rescued(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """JSON lines as text columns by name, plus ``_rescued`` and ``_source_file``.

    A key that is not among ``columns`` goes to ``_rescued`` as JSON, keys in order; a line that is no JSON object goes there
    whole. Missing keys are null, empty lines are dropped as Spark's reader does. Names match exactly. One pass over the lines.
    """
    lines = spark.read.text(path).where(F.trim("value") != "").select(F.col("_metadata.file_path").alias(SOURCE_FILE), "value")
    # an object must parse as one without a broken remainder; a duplicate key keeps its last value
    parsed = lines.withColumn("fields", F.when(F.substring(F.ltrim("value"), 1, 1) == "{", F.from_json("value", "map<string,string>", {"mode": "PERMISSIVE"})))
    known = F.array(*[F.lit(c) for c in columns]).cast("array<string>")
    extra = F.map_filter("fields", lambda k, _: ~F.array_contains(known, k))
    ordered = F.map_from_entries(F.array_sort(F.map_entries(extra)))
    rescued = F.when(F.col("fields").isNull(), F.col("value")).when(F.size(extra) > 0, F.to_json(ordered))
    return parsed.select(*[F.try_element_at("fields", F.lit(c)).alias(c) for c in columns], rescued.alias(RESCUED), SOURCE_FILE)


def csv_headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files by their header line: at most one row a file reaches the driver, and nothing but the first lines is kept."""
    first = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                                         F.monotonically_increasing_id().alias("n"), "value")
    heads = first.where(F.col("block") == 0).groupBy("file").agg(F.min_by("value", "n").alias("head")).collect()
    groups: dict[tuple[str, ...], list[str]] = {}
    for r in heads:
        groups.setdefault(tuple(_split_header(r["head"])), []).append(r["file"])
    return groups


def _split_header(line: str) -> list[str]:
    return [c.strip() for c in next(csv.reader([line]), [])]


def read_csv_rescued(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """CSV files with a header each, as text columns by name, plus ``_rescued`` and ``_source_file``.

    Files are read by groups of equal headers, so columns may come in another order, be missing (null) or be new: values of
    columns not among ``columns`` go to ``_rescued`` as JSON by name. A record with more or fewer fields than its
    file's header goes there whole, as ``{"record": ...}``, with null columns. Records do not span lines.
    """
    parts = []
    for head, files in sorted(csv_headers(spark, path).items()):
        # unique internal names; a repeated header name keeps its first column
        inner = [f"c{i}" for i in range(len(head))]
        schema = ", ".join([*[f"{c} string" for c in inner], "broken string"])
        rows = spark.read.schema(schema).csv(files, header=True, enforceSchema=True, mode="PERMISSIVE", columnNameOfCorruptRecord="broken")
        at = {name: inner[i] for i, name in reversed(list(enumerate(head)))}
        ok = F.col("broken").isNull()
        extra = [F.col(at[n]).alias(n) for n in dict.fromkeys(head) if n not in columns]
        rescued = F.when(~ok, F.to_json(F.struct(F.col("broken").alias("record"))))
        if extra:
            some = F.coalesce(*extra).isNotNull()
            rescued = rescued.when(some, F.to_json(F.struct(*extra)))
        own = [(F.when(ok, F.col(at[c])) if c in at else F.lit(None).cast("string")).alias(c) for c in columns]
        parts.append(rows.select(*own, rescued.alias(RESCUED), F.col("_metadata.file_path").alias(SOURCE_FILE)))
    if not parts:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in [*columns, RESCUED, SOURCE_FILE]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def land_rescued(spark: SparkSession, source_path: str, bronze_path: str, source_format: str, columns: Sequence[str],
                 batch_id: str, at: Column | None = None) -> None:
    """R1 for CSV and JSON of drifting shape: the batch lands in its own partition, the same batch again replaces it."""
    readers = {"json": read_json_rescued, "csv": read_csv_rescued}
    if source_format not in readers:
        raise ValueError(f"land_rescued reads {sorted(readers)}, not {source_format!r}")
    rows = readers[source_format](spark, source_path, columns)
    (
        rows.withColumns({INGESTED_AT: at if at is not None else F.current_timestamp(), LANDING_BATCH: F.lit(batch_id)})
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LANDING_BATCH).parquet(bronze_path)
    )


def land_batch(spark: SparkSession, source_path: str, bronze_path: str, source_format: str = "parquet",
               bronze_format: str = "parquet", options: dict[str, str] | None = None,
               at: Column | None = None, batch_id: str | None = None) -> None:
    """Append one batch of source files to the Bronze table; no casting, no
    dedup (Bronze keeps what arrived).

    With ``batch_id`` the batch lands in its own partition
    (``_landing_batch=<id>``) through a dynamic partition overwrite, so
    running the same batch again – a retried job, a replayed schedule –
    replaces it instead of appending it twice.
    """
    reader = spark.read.format(source_format)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    landed = with_landing_columns(reader.load(source_path), at)
    if batch_id is None:
        landed.write.mode("append").format(bronze_format).save(bronze_path)
        return
    (
        landed.withColumn(LANDING_BATCH, F.lit(batch_id))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(LANDING_BATCH).format(bronze_format).save(bronze_path)
    )


def file_name(col: str = SOURCE_FILE) -> Column:
    """Last path segment of a file URI."""
    return F.regexp_extract(F.col(col), r"[^/]+$", 0)
