"""Upsert by key (D1) and its storage form without a table format.

Semantics of the original merge: a source row whose key matches replaces the
whole target row, an unmatched source row is inserted, target-only rows stay,
nothing is deleted. A null key never matches, so it is inserted every time.

Storage form: the table is parquet partitioned by a hash bucket of the key
(``_bucket = pmod(xxhash64(keys), n)``), or by a caller-given layout value
computed from columns that never change for a key (e.g. the order month).
An upsert

1. writes the batch to a hidden folder of the table (``_batches/``) and counts its rows in
   the partitions it touches (at most ``MAX_TOUCHED``, else an error),
2. merges batch and the touched buckets only (partition pruning), bucket-locally: buckets are
   taken in groups whose batch keys may be broadcast, so the stored rows are never
   shuffled, however many keys the batch has (``bucket_groups``),
3. writes the result to a staging folder inside the table (``_staging/`` is
   hidden from readers), and
4. publishes exactly those buckets – by moving their folders where the file system renames
   cheaply, else with a dynamic partition overwrite – then drops both folders.

A table of plain files that something else wrote is taken over on the first
upsert: all its rows are merged into the bucket layout, published, and only then are the old
files dropped. Partition values are texts that no reader takes for numbers
(``v`` and the layout value, ``n`` for null), so ``01`` stays ``01``.

The table being read is never the folder being overwritten. Publishing is
not atomic across buckets; a run that dies after staging is finished by the
next call (``recover``), which re-publishes the complete staging folder –
publishing the same content twice is harmless. One writer per table.
"""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stratum.operators.conform import dedup_latest
from stratum.operators.joins import DEFAULT_BROADCAST_ROWS, at_most, fits, join_small
from stratum.sources import fs

log = logging.getLogger(__name__)

BUCKET = "_bucket"
STAGING = "_staging"
LAYOUT_MARKER = "_upsert_layout"  # 'buckets=<n>' or 'layout'; hidden from readers (leading '_', no '=')
BATCHES = "_batches"  # the batch of a running upsert; leftovers are dropped by the next call
COMPLETE = "_SUCCESS"  # written last into a staging folder: everything to publish is there
TAKEN_OVER = "_taken_over"  # in a staging folder: the old plain files to drop after publishing
_PATH_SAFE = re.compile(r"[A-Za-z0-9_.+-]+")
MAX_TOUCHED = 100_000


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _key_not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def prepare_source(source: DataFrame, target_columns: Sequence[str], keys: Sequence[str],
                   on_duplicate: str = "error", order_by: Sequence[str] = ()) -> DataFrame:
    """Shape the source like the target (Q17) and apply the duplicate policy.

    ``on_duplicate``: ``error`` raises when a non-null key repeats (a merge
    cannot tell which copy wins), ``latest`` keeps the row with the greatest
    ``order_by`` per key, ``keep`` applies no check.
    """
    missing = [c for c in target_columns if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    src = source.select(*target_columns)
    if on_duplicate == "latest":
        return _latest_keep_null_keys(src, keys, order_by)
    if on_duplicate == "error":
        repeated = src.where(_key_not_null(keys)).groupBy(*keys).count().where(F.col("count") > 1)
        if not at_most(repeated, 0):
            raise ValueError(f"source holds several rows for one key {list(keys)}; dedup it first")
    elif on_duplicate != "keep":
        raise ValueError("on_duplicate must be 'error', 'latest' or 'keep'")
    return src


def _latest_keep_null_keys(src: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Latest row per non-null key; rows with a null key are all kept."""
    present = src.where(_key_not_null(keys))
    return dedup_latest(present, keys, order_by).unionByName(src.where(~_key_not_null(keys)))


def merge_frames(target: DataFrame, source: DataFrame, keys: Sequence[str], on_duplicate: str = "error",
                 order_by: Sequence[str] = (), guard: str | None = None,
                 max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """D1 as a DataFrame: the table after upserting ``source`` into ``target``.

    Without ``guard``: ``target ▷ source`` (anti-join on the keys; the source
    keys are broadcast when counted small, so the target is not shuffled)
    ``∪ source``. With ``guard`` (a version column, Q16): a matched row is
    replaced only when the source version is not older; when the batch's
    keys are counted small, only target rows with those keys are shuffled
    against the batch, the others pass through a broadcast anti-join. The
    target is expected to hold one row per non-null key, as every table
    written here does unless created with ``on_duplicate='keep'``.
    """
    src = prepare_source(source, target.columns, keys, on_duplicate, order_by)
    if guard is None:
        src_keys = src.where(_key_not_null(keys)).select(*keys)
        kept = join_small(target, src_keys, list(keys), "left_anti", max_broadcast_rows)
        return kept.unionByName(src)
    if guard not in target.columns:
        raise ValueError(f"guard column {guard!r} not in target")
    src_keys = src.where(_key_not_null(keys)).select(*keys)
    untouched, contenders = None, target
    if fits(src_keys, max_broadcast_rows):
        # only target rows whose key is in the batch compete with it; the rest
        # pass through a broadcast anti-join, so the target is not shuffled
        batch_keys = F.broadcast(src_keys)
        untouched = target.join(batch_keys, list(keys), "left_anti").select(*target.columns)
        contenders = target.join(batch_keys, list(keys), "left_semi")
    tagged = contenders.withColumn("_from_source", F.lit(0)).unionByName(src.withColumn("_from_source", F.lit(1)))
    present = tagged.where(_key_not_null(keys))
    # greatest (guard, from_source) wins: newer version, source on ties
    winners = dedup_latest(present.select(*keys, guard, "_from_source", *[c for c in target.columns
                                                                          if c not in keys and c != guard]),
                           keys, [guard, "_from_source"])
    nulls = tagged.where(~_key_not_null(keys))
    merged = winners.unionByName(nulls).select(*target.columns)
    return merged if untouched is None else untouched.unionByName(merged)


def recover(spark, path: str) -> int:
    """Finish or discard staging folders left by an interrupted upsert.

    A staging folder with a ``_SUCCESS`` marker is complete: publish it again.
    One without it never reached publishing: the table is intact, drop it.
    Returns the number of folders re-published.
    """
    done = 0
    for folder in fs.list_dirs(spark, f"{path}/{STAGING}"):
        if fs.exists(spark, f"{folder}/{COMPLETE}"):
            log.warning("re-publishing staged upsert %s", folder)
            _publish(spark, folder, path)
            _drop_taken_over(spark, folder, path)
            done += 1
        fs.delete(spark, folder)
    for folder in fs.list_dirs(spark, f"{path}/{BATCHES}"):
        fs.delete(spark, folder)
    return done


def _drop_taken_over(spark, staging: str, path: str) -> None:
    """After publishing a take-over: drop the plain files whose rows are now in the buckets."""
    if fs.exists(spark, f"{staging}/{TAKEN_OVER}"):
        for name in fs.list_files(spark, path):
            if not name.startswith(("_", ".")):
                fs.delete(spark, f"{path}/{name}")


RENAMES = ("file", "hdfs", "viewfs", "abfs", "abfss")  # file systems whose folders move without copying


def _publish(spark, staging: str, path: str, rename: bool | None = None) -> None:
    """Replace the staged buckets' folders in the table. A second call after a crash finishes what is left in ``staging``.

    Where folders can be moved, the staged files become the table's files: nothing is read or written again. Elsewhere (object stores
    that copy on rename) Spark writes them with a dynamic partition overwrite."""
    if rename if rename is not None else fs.scheme(spark, path) in RENAMES:
        for folder in fs.list_dirs(spark, staging):
            name = folder.rsplit("/", 1)[-1]
            if name.startswith(f"{BUCKET}="):
                fs.replace_dir(spark, folder, f"{path}/{name}")
        return
    (
        spark.read.parquet(staging)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET)
        .parquet(path)
    )


def _read_layout(spark, path: str) -> str | None:
    return fs.read_text(spark, f"{path}/{LAYOUT_MARKER}")


def has_layout(spark, path: str) -> bool:
    """Whether a table was created at ``path`` by an upsert (its layout is known)."""
    return _read_layout(spark, path) is not None


def _write_layout(spark, path: str, buckets: int | None) -> None:
    fs.write_text(spark, f"{path}/{LAYOUT_MARKER}", "layout" if buckets is None else f"buckets={buckets}")


def _bucket_count(spark, path: str, keys: Sequence[str], buckets: int | None, recorded: str | None) -> int:
    """The table's bucket count, kept in the layout marker (written before
    the first data) and checked on every later call: another count
    would send a key to another folder and keep its old version alive. When the marker
    is lost, the caller must name the count, and it is accepted only if every stored key lies in its bucket."""
    if recorded == "layout":
        raise ValueError("the table is partitioned by a layout expression; pass layout=")
    if recorded is None:
        if buckets is None:
            raise ValueError(f"the layout marker of {path} is missing; name the table's bucket count")
        stored = spark.read.parquet(path)
        if not at_most(stored.where(bucket_of(keys, buckets) != F.col(BUCKET).cast("int")), 0):
            raise ValueError(f"table at {path} was not written with {buckets} buckets")
        _write_layout(spark, path, buckets)
        return buckets
    have = int(recorded.split("=", 1)[1])
    if buckets is not None and buckets != have:
        raise ValueError(f"table at {path} has {have} buckets, not {buckets}")
    return have


def bucket_groups(rows: dict, max_rows: int) -> list[list]:
    """Touched partitions in groups whose batch rows (``rows`` by partition) are at most ``max_rows`` together.

    The batch keys of a group are broadcast and meet the group's stored rows where those are read. A
    partition that alone has more is a group of its own (its rows alone are shuffled)."""
    groups, room = [], 0
    for value in sorted(rows, key=str):
        if not groups or rows[value] > room:
            groups.append([])
            room = max_rows
        groups[-1].append(value)
        room -= rows[value]
    return groups


def layout_value(layout: Column) -> Column:
    """Partition text of a layout value: never null, never taken for a number."""
    return F.coalesce(F.concat(F.lit("v"), layout.cast("string")), F.lit("n"))


def _partition_values(spark, path: str) -> set[str]:
    """Partition folder values of the table: one top-level listing."""
    present = set()
    for folder in fs.list_dirs(spark, path):
        name = folder.rsplit("/", 1)[-1]
        if name.startswith(f"{BUCKET}="):
            present.add(name.split("=", 1)[1])
    return present


def _touched_partitions(spark, path: str, touched: list, present: set[str]) -> DataFrame:
    """The table restricted to the touched partitions.

    Reads only the touched partition folders (``present`` comes from one
    top-level listing), so an upsert never lists every file of a large
    table. Partition values that are not plain names fall back to
    a filtered read of the whole table.
    """
    values = [str(v) for v in touched]
    if all(_PATH_SAFE.fullmatch(v) for v in values):
        reader = spark.read.option("basePath", path)
        folders = [f"{path}/{BUCKET}={v}" for v in values if v in present]
        if folders:
            return reader.parquet(*folders)
        # nothing touched exists yet: the columns of one partition, no rows
        return reader.parquet(f"{path}/{BUCKET}={min(present)}").where(F.lit(False))
    return spark.read.parquet(path).where(F.col(BUCKET).isin(touched))


def _foreign_files(spark, path: str) -> bool:
    """Whether the folder holds a table of plain files that this library did not write.

    One partitioned by something else is refused: its layout cannot be kept."""
    other = [d.rsplit("/", 1)[-1] for d in fs.list_dirs(spark, path)]
    other = [d for d in other if not d.startswith(("_", "."))]
    if other:
        raise ValueError(f"{path} holds a table partitioned by {other[0].split('=')[0]!r}; it cannot be upserted in place")
    return any(not f.startswith(("_", ".")) for f in fs.list_files(spark, path))


def upsert_table(source: DataFrame, path: str, keys: Sequence[str], buckets: int | None = None,
                 on_duplicate: str = "error", order_by: Sequence[str] = (), guard: str | None = None,
                 fmt: str = "parquet", layout: Column | None = None,
                 max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> dict:
    """D1 + D2: upsert ``source`` into the table at ``path`` (created on first
    use, S5/S6). Returns a small summary dict.

    ``buckets`` (hash layout) is fixed when the table is created and kept in
    a hidden marker file; later calls may omit it. Choose it so a bucket
    holds about 1 GB: an upsert rewrites every bucket it touches.
    ``layout`` replaces the key hash as the partition value, e.g.
    ``date_format('o_orderdate', 'yyyyMM')``: a change batch of recent rows
    then rewrites only recent partitions. It must be computed from columns
    that never change for a key, so every version of a key lands in the same
    partition (otherwise an old version would survive in its old partition).

    A call reads the marker and the table's top-level listing, then only the partitions
    the batch touches: the cost follows the batch, not the table. ``buckets`` or ``layout`` must be
    given when the table is created or taken over (see the module text).
    """
    spark = source.sparkSession
    if fmt == "delta":
        if buckets is not None or layout is not None:
            raise ValueError("buckets and layout belong to the parquet form; a Delta table keeps its own")
        return _upsert_delta(source, path, keys, on_duplicate, order_by, guard)
    if fmt != "parquet":
        raise ValueError("staged upsert supports parquet (or delta when installed)")
    recovered = recover(spark, path)
    recorded = _read_layout(spark, path)
    present = _partition_values(spark, path)
    foreign = not present and _foreign_files(spark, path)
    if not present:  # no table yet, one created from an empty batch, or plain files to take over
        n = buckets if buckets is not None or recorded in (None, "layout") else int(recorded.split("=", 1)[1])
        if (n is None) == (layout is None):
            raise ValueError("name either buckets or layout to create a table; a bucket of about 1 GB is a good size")
        part = layout_value(layout) if layout is not None else bucket_of(keys, n)
        # the marker comes first: data without it would have an unknown layout
        _write_layout(spark, path, None if layout is not None else n)
        if not foreign:
            src = prepare_source(source, source.columns, keys, on_duplicate, order_by)
            # rows grouped by partition value before the write: a few well-sized
            # files per value instead of one file per task and value (AQE splits
            # a value holding a large share over several tasks). Appended: nothing is ever overwritten here
            src.withColumn(BUCKET, part).hint("rebalance", BUCKET).write.mode("append").partitionBy(BUCKET).parquet(path)
            return {"mode": "initial", "buckets_touched": None, "recovered": recovered}
    elif layout is not None:
        if recorded is not None and recorded != "layout":
            raise ValueError("the table is bucketed by key hash; do not pass layout=")
        if any(not v.startswith(("v", "n")) for v in present):
            raise ValueError(f"{path} has partition folders of another form")
        if recorded is None:
            _write_layout(spark, path, None)
        part = layout_value(layout)
    else:
        part = bucket_of(keys, _bucket_count(spark, path, keys, buckets, recorded))
    # the batch feeds several actions (touched partitions, duplicate check,
    # merge): write it once, drop it afterwards
    batch = f"{path}/{BATCHES}/{uuid.uuid4().hex}"
    try:
        source.withColumn(BUCKET, part).write.parquet(batch)
        tagged = spark.read.parquet(batch)
        counts = tagged.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n")).limit(MAX_TOUCHED + 1).collect()
        if len(counts) > MAX_TOUCHED:
            raise ValueError(f"the batch touches more than {MAX_TOUCHED} partitions; choose a coarser layout")
        touched = sorted(r[BUCKET] for r in counts)
        if not touched and not foreign:
            return {"mode": "noop", "buckets_touched": 0, "recovered": recovered}
        groups = [touched] if foreign else bucket_groups({r[BUCKET]: r["n"] for r in counts}, max_broadcast_rows)
        if len(groups) > 1:
            # by partition on disk, so that each group reads its own part of the batch only
            tagged.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{batch}_grouped")
        staging = f"{path}/{STAGING}/{uuid.uuid4().hex}"
        rows = 0
        for group in groups:
            target = spark.read.parquet(path).withColumn(BUCKET, part) if foreign else _touched_partitions(spark, path, group, present)
            columns = [c for c in target.columns if c != BUCKET]
            own = tagged if len(groups) == 1 else _touched_partitions(spark, f"{batch}_grouped", group, {str(v) for v in touched})
            src = prepare_source(own, [*columns, BUCKET], keys, on_duplicate, order_by)
            # regrouped by partition as a whole: a merge that shuffles by key would write a file
            # per task and partition
            merged = merge_frames(target, src, keys, on_duplicate="keep", guard=guard, max_broadcast_rows=max_broadcast_rows).hint("rebalance", BUCKET)
            # rows in the rewritten partitions, counted while staging (no extra pass)
            written = Observation("upsert_staging")
            # a group's files are no complete staging: the marker below is
            merged.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("append") \
                .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy(BUCKET).parquet(staging)
            rows += written.get["rows"]
        if foreign:
            # before the mark: with it there, the next call can finish a take-over
            fs.write_text(spark, f"{staging}/{TAKEN_OVER}", "plain files")
        fs.write_text(spark, f"{staging}/{COMPLETE}", "complete")
        _publish(spark, staging, path)
        _drop_taken_over(spark, staging, path)
        fs.delete(spark, staging)
    finally:
        fs.delete(spark, batch)
        fs.delete(spark, f"{batch}_grouped")
    return {"mode": "taken over" if foreign else "merge", "buckets_touched": len(touched), "groups": len(groups),
            "rows_in_touched": rows, "recovered": recovered}


def _upsert_delta(source: DataFrame, path: str, keys: Sequence[str], on_duplicate: str, order_by: Sequence[str],
                  guard: str | None) -> dict:
    """Delta route: the table's own merge. Needs the Delta package, which is not part of this library."""
    try:
        from delta.tables import DeltaTable  # optional dependency
    except ImportError as e:
        raise ValueError("a Delta table needs the delta package on the driver and its jars on the cluster; "
                         "use fmt='parquet' without them") from e

    spark = source.sparkSession
    if not DeltaTable.isDeltaTable(spark, path):
        src = prepare_source(source, source.columns, keys, on_duplicate, order_by)
        src.write.format("delta").mode("errorifexists").save(path)
        return {"mode": "initial"}
    table = DeltaTable.forPath(spark, path)
    src = prepare_source(source, table.toDF().columns, keys, on_duplicate, order_by)
    cond = " AND ".join(f"target.`{k}` = source.`{k}`" for k in keys)
    newer = None if guard is None else f"target.`{guard}` IS NULL OR source.`{guard}` >= target.`{guard}`"
    (
        table.alias("target")
        .merge(src.alias("source"), cond)
        .whenMatchedUpdateAll(condition=newer)
        .whenNotMatchedInsertAll()
        .execute()
    )
    return {"mode": "merge"}
