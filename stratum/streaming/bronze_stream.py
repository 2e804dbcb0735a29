"""Streaming Bronze landing (R2) and streaming Silver upsert.

``dedup_within_watermark`` is Spark's own stateful dedup, which drops late rows. ``land_stream`` keeps them: it splits each
micro-batch by the watermark of the batches before it into kept, late and unparseable rows. ``newest_versions``
holds the newest version of each key in state, so that a stream upsert writes one row a key.

Both read a folder of arriving files with Structured Streaming. The event
time is cast to a session timestamp before the watermark (file timestamps
may be ``timestamp_ntz``). Dedup state lives in the state store for the
watermark delay only; at cluster scale use the RocksDB state store provider
(a session setting, left to the job's configuration).

Restarts: the checkpoint folder records offsets and state, so a restarted
query resumes where it stopped; a replayed micro-batch upserts the same rows
by key and leaves the Silver table unchanged (except rows with a null key,
which never match and are inserted again, as in the original merge).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructField, StructType, TimestampType

from stratum.operators.conform import dedup_latest, enforce_schema
from stratum.operators.joins import fits
from stratum.operators.upsert import has_layout, upsert_table
from stratum.sources import fs

EVENT_TIME = "_event_time"
PART, BATCH = "_part", "_batch"
KEPT, LATE, UNPARSEABLE = "kept", "late", "unparseable"


def read_arrivals(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None, max_bytes_per_trigger: str | None = None) -> DataFrame:
    """Arriving files as a stream; the two limits bound each micro-batch
    (and so the work any one key can put on one task in a batch)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.load(path)


def split_unparseable(stream: DataFrame, ts_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose event time parses, rows whose event time doesn't).

    The second stream belongs in a side table: without an event time a row has no place before or
    behind a watermark, and its dedup state would expire at once."""
    parsed = F.col(ts_col).try_cast("timestamp")
    return stream.where(parsed.isNotNull()), stream.where(parsed.isNull())


def dedup_within_watermark(stream: DataFrame, ts_col: str, delay: str, keys: Sequence[str]) -> DataFrame:
    """R2: drop re-deliveries of a key seen within ``delay`` of event time.

    State for a key is kept until the watermark (max event time seen minus
    ``delay``) passes it. Rows behind the watermark are dropped (``run_available`` counts them); Spark judges
    lateness against the previous micro-batch's watermark, so a row is
    dropped once the watermark had moved past it one batch earlier. Choose
    ``delay`` to cover the expected lateness. Rows without an event time are left out: see ``split_unparseable``.

    Only Spark's stateful step decides which copy stays. Dropping copies earlier, before lateness
    is judged, could keep a late copy and lose the one in time. A group of copies meets in its key's
    state partition; the micro-batch bound (``read_arrivals``) limits how many of them at once.
    """
    timed = stream.withColumn(EVENT_TIME, F.col(ts_col).try_cast("timestamp")).where(F.col(EVENT_TIME).isNotNull())
    return (
        timed.withWatermark(EVENT_TIME, delay)
        .dropDuplicatesWithinWatermark(list(keys))
        .drop(EVENT_TIME)
    )


def run_available(stream: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet") -> dict[str, int]:
    """Process everything available now into a file sink, then stop.

    Returns the rows read and the rows dropped as late, over the micro-batches whose progress Spark still holds (the last 100)."""
    query = (
        stream.writeStream.format(fmt)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(sink_path)
    )
    query.awaitTermination()
    _raise_if_failed(query)
    progress = query.recentProgress
    return {"rows": sum(p["numInputRows"] for p in progress),
            "late": sum(o["numRowsDroppedByWatermark"] for p in progress for o in p["stateOperators"])}


def _raise_if_failed(query: StreamingQuery) -> None:
    err = query.exception()
    if err is not None:
        raise RuntimeError(f"streaming query failed: {err}")


def upsert_batches(silver_path: str, keys: Sequence[str], order_by: Sequence[str],
                   schema: StructType | None = None, guard: str | None = None,
                   buckets: int | None = None, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that enforces the schema, keeps the
    latest version per key inside the micro-batch and upserts it.

    With ``guard`` a late, older version never replaces a newer one, so the
    result does not depend on arrival order; without it, the last batch wins
    (the original merge's rule). ``fmt='delta'`` merges into a Delta table where the Delta package is installed.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        # later upserts into files write the batch once and read that; others read it several times, which would run the
        # stream's stateful step as often
        once = fmt == "parquet" and has_layout(batch.sparkSession, silver_path)
        rows = batch if once else batch.persist()
        df = enforce_schema(rows, schema) if schema is not None else rows
        # same duplicate policy as the batch job: latest row per non-null key
        # (an aggregation, map-side first), every null-key row kept
        try:
            upsert_table(df, silver_path, keys, buckets=buckets, on_duplicate="latest", order_by=order_by, guard=guard, fmt=fmt)
        finally:
            if not once:
                rows.unpersist()

    return apply


def run_stream_upsert(stream: DataFrame, silver_path: str, checkpoint: str, keys: Sequence[str],
                      order_by: Sequence[str], schema: StructType | None = None, guard: str | None = None,
                      buckets: int | None = None, fmt: str = "parquet") -> None:
    query = (
        stream.writeStream.foreachBatch(upsert_batches(silver_path, keys, order_by, schema, guard, buckets, fmt))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    _raise_if_failed(query)


# ---------------------------------------------------------------- landing that keeps late rows


def _delay_seconds(spark: SparkSession, delay: str) -> int:
    days = spark.sql(f"SELECT unix_seconds(timestamp '2000-01-01 00:00:00' + INTERVAL {delay}) - unix_seconds(timestamp '2000-01-01 00:00:00') AS s")
    return int(days.first()["s"])


def _watermark_before(spark: SparkSession, checkpoint: str, batch_id: int, seconds: int) -> int | None:
    """Watermark in microseconds: the greatest event time of the earlier batches less the delay; None before there is one."""
    text = fs.read_text(spark, f"{checkpoint}/event_times/{batch_id - 1}") if batch_id else None
    return int(text) - seconds * 1_000_000 if text not in (None, "", "none") else None


def land_batches(path: str, checkpoint: str, ts_col: str, delay: str, keys: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that lands every row of a micro-batch somewhere.

    The table at ``path`` has a partition a micro-batch and part: ``kept`` (in time, one row a key: the greatest event time,
    then the other columns decide, not arrival), ``late`` (behind the watermark of the earlier batches) and ``unparseable`` (no
    event time). A key already kept within ``delay`` of a row's event time is a re-delivery and dropped; that test reads only the kept rows'
    keys and times of that stretch of event time.

    A replayed batch overwrites its own partitions and sees only earlier ones, so it lands the same rows. The
    greatest event time so far is noted for each batch under ``checkpoint``.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seconds = _delay_seconds(spark, delay)
        limit = _watermark_before(spark, checkpoint, batch_id, seconds)
        timed = batch.withColumn(EVENT_TIME, F.col(ts_col).try_cast("timestamp"))
        micros = F.unix_micros(EVENT_TIME)
        late = F.lit(False) if limit is None else micros < F.lit(limit)
        part = F.when(F.col(EVENT_TIME).isNull(), UNPARSEABLE).when(late, LATE).otherwise(KEPT)
        tagged = timed.withColumn(PART, part).persist()  # feeds the bounds and three sinks; lost blocks are read again from the files
        try:
            seen = tagged.where(F.col(PART) != UNPARSEABLE).agg(F.max(micros).alias("top"), F.min(F.when(F.col(PART) == KEPT, micros)).alias("low")).first()
            fresh = dedup_latest(tagged.where(F.col(PART) == KEPT), keys, [EVENT_TIME])
            known = _kept_before(spark, path, batch_id)
            if known is not None and seen["low"] is not None:
                fresh = _not_yet_kept(fresh, known, keys, seconds, seen["low"])
            rows = fresh.unionByName(tagged.where(F.col(PART) != KEPT)).withColumn(BATCH, F.lit(f"b{batch_id:09d}"))
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH, PART).parquet(path)
            earlier = None if limit is None else limit + seconds * 1_000_000
            top = max((x for x in (seen["top"], earlier) if x is not None), default=None)
            fs.write_text(spark, f"{checkpoint}/event_times/{batch_id}", "none" if top is None else str(top))
        finally:
            tagged.unpersist()

    return apply


def _kept_before(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    earlier = [d for d in fs.list_dirs(spark, path) if d.rsplit("/", 1)[-1].startswith(f"{BATCH}=b") and int(d.rsplit("=b", 1)[1]) < batch_id]
    folders = [f"{d}/{PART}={KEPT}" for d in earlier if fs.exists(spark, f"{d}/{PART}={KEPT}")]
    return spark.read.option("basePath", path).parquet(*folders) if folders else None


def _not_yet_kept(fresh: DataFrame, known: DataFrame, keys: Sequence[str], seconds: int, low: int) -> DataFrame:
    """Rows of ``fresh`` whose key no kept row has within ``seconds`` of event time (null keys equal each other)."""
    reach = seconds * 1_000_000
    old = known.where(F.unix_micros(EVENT_TIME) >= F.lit(low - reach)).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.unix_micros(EVENT_TIME).alias("_seen"))
    same: Column = F.abs(F.unix_micros(EVENT_TIME) - F.col("_seen")) <= F.lit(reach)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return fresh.join(F.broadcast(old) if fits(old) else old, same, "left_anti")


def land_stream(stream: DataFrame, path: str, checkpoint: str, ts_col: str, delay: str, keys: Sequence[str]) -> None:
    """R2 without losing rows: everything available now goes to the parts of the table at ``path`` (``land_batches``)."""
    query = (
        stream.writeStream.foreachBatch(land_batches(path, checkpoint, ts_col, delay, keys))
        .option("checkpointLocation", f"{checkpoint}/query")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    _raise_if_failed(query)


def read_landed(spark: SparkSession, path: str, schema: StructType, part: str) -> DataFrame:
    """The rows of one part (``kept``, ``late`` or ``unparseable``) with the stream's columns."""
    full = StructType([*schema.fields, StructField(EVENT_TIME, TimestampType())]).add(BATCH, "string").add(PART, "string")
    return spark.read.schema(full).parquet(path).where(F.col(PART) == part).select(*schema.names)


# ---------------------------------------------------------------- newest version of each key in state

STATE_GROUPS = 4096
_GROUP, _KEEP_UNTIL, _KNOWN, _PLACE = "_group", "_keep_until", "_known", "_place"
_STATE_CHUNK = 100_000  # waiting rows of a group beyond its state's that are reduced together

def newest_versions(stream: DataFrame, keys: Sequence[str], version: str, keep: str = "7 days", groups: int = STATE_GROUPS) -> DataFrame:
    """Stream of the rows that are newer, by ``version`` and then by their other columns, than every row of their key so far: at most one
    row a key and micro-batch.

    Keys are dealt by their hash over ``groups`` groups. The state of a group is the newest row of each of its keys, as
    compressed Arrow data, so Python is called once a group and micro-batch and handles its keys together. A
    processing-time timer drops a key when no row of it has come for ``keep``, which bounds the state (after that the guard of the
    upsert still turns older rows away). A micro-batch rewrites the groups that it touches: raise ``groups`` for
    hundreds of millions of keys. A checkpoint must go on with the number it was started with. Rows without a key or a version have
    no order: split them off first. Columns of nested types take no part in the order.
    """
    columns, span = stream.columns, int(pd.Timedelta(keep).total_seconds() * 1000)
    # naive timestamps as pandas has them; null and not-a-number are one to pandas
    plain = pa.schema([pa.field(f.name, pa.timestamp("us") if pa.types.is_timestamp(f.type) else f.type) for f in to_arrow_schema(stream.schema)])
    held = plain.append(pa.field(_KEEP_UNTIL, pa.int64()))
    order = [version, *[c for c in columns if c not in keys and c != version and not pa.types.is_nested(plain.field(c).type)]]

    def newest(table: pa.Table) -> pa.Table:
        """The greatest row of each key; of equal ones the one that has been in the state. The latest end of its time is the key's."""
        by = [(c, "ascending") for c in [*order, _KNOWN]]
        table = table.take(pc.sort_indices(table, sort_keys=by, null_placement="at_start"))
        table = table.append_column(_PLACE, pa.array(range(len(table)), pa.int64()))
        top = table.group_by(list(keys), use_threads=False).aggregate([(_PLACE, "max"), (_KEEP_UNTIL, "max")])
        rows = table.drop_columns([_KEEP_UNTIL, _PLACE]).take(top.column(f"{_PLACE}_max"))
        return rows.append_column(held.field(_KEEP_UNTIL), top.column(f"{_KEEP_UNTIL}_max")).select([*held.names, _KNOWN])

    def marked(table: pa.Table, known: bool) -> pa.Table:
        return table.append_column(_KNOWN, pa.array([known] * len(table), pa.bool_()))

    def update(_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        best = marked(_unpacked(state.get[0]) if state.exists else held.empty_table(), True)
        if not state.hasTimedOut:
            waiting, n = [], 0
            for pdf in batches:
                rows = pa.Table.from_pandas(pdf, schema=plain, preserve_index=False).replace_schema_metadata(None)
                due = pa.array([now + span] * len(rows), pa.int64())
                waiting.append(marked(rows.append_column(held.field(_KEEP_UNTIL), due), False))
                n += len(rows)
                if n > len(best) + _STATE_CHUNK:
                    best, waiting, n = newest(pa.concat_tables([best, *waiting])), [], 0
            if waiting:
                best = newest(pa.concat_tables([best, *waiting]))
        best = best.filter(pc.greater(best.column(_KEEP_UNTIL), now))
        if not len(best):
            state.remove()
            return
        state.update((_packed(best.select(held.names)),))
        state.setTimeoutDuration(max(1, pc.min(best.column(_KEEP_UNTIL)).as_py() - now))
        fresh = best.filter(pc.invert(best.column(_KNOWN))).select(columns)
        if len(fresh):
            yield fresh.to_pandas(date_as_object=True, integer_object_nulls=True)

    group = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(groups))
    return stream.withColumn(_GROUP, group).groupBy(_GROUP).applyInPandasWithState(
        update, stream.schema, "rows binary", "update", GroupStateTimeout.ProcessingTimeTimeout)


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(bytes(data)).read_all()


def run_stream_upsert_newest(stream: DataFrame, silver_path: str, checkpoint: str, keys: Sequence[str], version: str,
                             schema: StructType | None = None, buckets: int | None = None, keep: str = "7 days",
                             fmt: str = "parquet") -> None:
    """R3 with the newest version of each key in state: no older version reaches storage, whatever the order of arrival.

    The schema is enforced before the state, so versions compare as their type. Rows without a key or version go round the state
    into the same upsert, which inserts null keys as they come (the original merge's rule)."""
    typed = enforce_schema(stream, schema) if schema is not None else stream
    known = F.col(version).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    upsert = upsert_batches(silver_path, keys, [version], None, version, buckets, fmt)
    for name, part in (("newest", newest_versions(typed.where(known), keys, version, keep)), ("other", typed.where(~known))):
        writer = (
            part.writeStream.foreachBatch(upsert)
            .outputMode("update")
            .option("checkpointLocation", f"{checkpoint}/{name}")
            .trigger(availableNow=True)
        )
        with _no_empty_batches(stream.sparkSession):
            query = writer.start()
        query.awaitTermination()
        _raise_if_failed(query)


@contextmanager
def _no_empty_batches(spark: SparkSession) -> Iterator[None]:
    """For queries started inside: no micro-batches without data. Processing-time timers would ask for them for ever, and a
    query over what is available now would not end; due timers fire in the next batch with data. A query keeps the settings it
    was started with, so the session's own is put back at once."""
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)
