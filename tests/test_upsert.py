import pytest
from pyspark.sql import functions as F

from stratum.operators import upsert as up

COLS = "id long, v string, ts int"


def frame(spark, rows):
    return spark.createDataFrame(rows, COLS)


def as_set(df):
    return sorted(map(tuple, df.select("id", "v", "ts").collect()), key=lambda r: (r[0] is None, r))


def test_merge_replaces_inserts_and_keeps(spark):
    target = frame(spark, [(1, "a", 1), (2, "b", 1)])
    source = frame(spark, [(2, "B", 2), (3, "c", 2)])
    assert as_set(up.merge_frames(target, source, ["id"])) == [(1, "a", 1), (2, "B", 2), (3, "c", 2)]


def test_null_keys_are_inserted_every_time(spark):  # Q6
    target = frame(spark, [(None, "x", 1)])
    assert len(as_set(up.merge_frames(target, frame(spark, [(None, "x", 1)]), ["id"]))) == 2


def test_duplicate_source_keys_raise(spark):  # Q5
    with pytest.raises(ValueError):
        up.merge_frames(frame(spark, []), frame(spark, [(1, "a", 1), (1, "b", 2)]), ["id"])
    got = up.merge_frames(frame(spark, []), frame(spark, [(1, "a", 1), (1, "b", 2)]), ["id"],
                          on_duplicate="latest", order_by=["ts"])
    assert as_set(got) == [(1, "b", 2)]


def test_missing_target_column_raises_extra_ignored(spark):  # Q17
    target = frame(spark, [(1, "a", 1)])
    with pytest.raises(ValueError):
        up.merge_frames(target, spark.createDataFrame([(1, "a")], "id long, v string"), ["id"])
    extra = spark.createDataFrame([(1, "z", 5, "x")], "id long, v string, ts int, more string")
    assert up.merge_frames(target, extra, ["id"]).columns == ["id", "v", "ts"]


def test_guard_keeps_newer_target(spark):  # Q16
    target = frame(spark, [(1, "new", 5), (2, "old", 1)])
    source = frame(spark, [(1, "late", 3), (2, "newer", 4)])
    assert as_set(up.merge_frames(target, source, ["id"])) == [(1, "late", 3), (2, "newer", 4)]
    assert as_set(up.merge_frames(target, source, ["id"], guard="ts")) == [(1, "new", 5), (2, "newer", 4)]


def test_table_upsert_initial_merge_and_replay(spark, scratch):  # D2, S5, S6
    path = scratch("orders")
    first = frame(spark, [(i, f"v{i}", 1) for i in range(100)])
    assert up.upsert_table(first, path, ["id"], buckets=8)["mode"] == "initial"
    change = frame(spark, [(5, "five", 2), (500, "new", 2)])
    info = up.upsert_table(change, path, ["id"], buckets=8)
    assert info["mode"] == "merge" and info["buckets_touched"] <= 2
    after = as_set(spark.read.parquet(path))
    up.upsert_table(change, path, ["id"], buckets=8)
    assert as_set(spark.read.parquet(path)) == after  # replay is a no-op
    assert len(after) == 101 and (5, "five", 2) in after and (500, "new", 2) in after


def test_recover_republishes_complete_staging(spark, scratch):
    path = scratch("orders")
    up.upsert_table(frame(spark, [(1, "a", 1), (2, "b", 1)]), path, ["id"], buckets=4)
    # simulate a crash after staging: staged content exists, table not yet published
    current = spark.read.parquet(path)
    staged = up.merge_frames(current, frame(spark, [(1, "A", 2)]).withColumn(up.BUCKET, up.bucket_of(["id"], 4)),
                             ["id"]).where(F.col(up.BUCKET) == up_bucket(spark, 1, 4))
    staged.write.partitionBy(up.BUCKET).parquet(f"{path}/{up.STAGING}/crashed")
    assert up.recover(spark, path) == 1
    assert as_set(spark.read.parquet(path)) == [(1, "A", 2), (2, "b", 1)]


def up_bucket(spark, key, n):
    """Bucket of one long key (``range`` yields a long column named ``id``)."""
    return spark.range(key, key + 1).select(up.bucket_of(["id"], n)).first()[0]


def test_layout_rewrites_only_touched_partitions(spark, scratch):
    path = scratch("by_month")
    month = F.col("ts")  # immutable per key in this data
    up.upsert_table(frame(spark, [(i, "a", i % 4) for i in range(40)]), path, ["id"], layout=month)
    info = up.upsert_table(frame(spark, [(1, "b", 1), (5, "c", 1), (100, "d", 1)]), path, ["id"], layout=month)
    assert info["buckets_touched"] == 1
    got = {r.id: r.v for r in spark.read.parquet(path).collect()}
    assert len(got) == 41 and got[1] == "b" and got[5] == "c" and got[100] == "d" and got[2] == "a"


def test_bucket_count_is_recorded_and_checked(spark, scratch):
    path = scratch("buckets")
    first = spark.range(200).select("id", F.lit("a").alias("v"), F.lit(1).alias("ts")).repartition(8)
    up.upsert_table(first, path, ["id"], buckets=4)
    # rebalanced on the bucket before writing: one file per bucket, not one per task and bucket
    files = spark.read.parquet(path).select(F.input_file_name()).distinct().count()
    assert files == 4
    with pytest.raises(ValueError):
        up.upsert_table(frame(spark, [(1, "b", 2)]), path, ["id"], buckets=8)
    info = up.upsert_table(frame(spark, [(1, "b", 2)]), path, ["id"])  # count taken from the table
    assert info["buckets_touched"] == 1
    got = spark.read.parquet(path)
    assert got.count() == 200 and got.where("id = 1").select("v").first()[0] == "b"


def test_upsert_reads_only_touched_partition_folders(spark, scratch):
    path = scratch("touched")
    up.upsert_table(spark.range(400).select("id", F.lit("a").alias("v"), F.lit(1).alias("ts")), path, ["id"],
                    buckets=16)
    present = up._partition_values(spark, path)
    assert len(present) == 16
    target = up._touched_partitions(spark, path, [3, 5], present)
    folders = {f.rsplit("/", 2)[-2] for f in target.inputFiles()}
    assert folders == {"_bucket=3", "_bucket=5"}
    assert target.count() == spark.read.parquet(path).where("_bucket in (3, 5)").count()
    assert up._touched_partitions(spark, path, [99], present).count() == 0  # not there yet: no rows, same columns


def test_null_layout_partition_keeps_its_rows(spark, scratch):
    path = scratch("null_layout")
    layout = F.col("ts").cast("string")  # null ts -> the default partition
    first = frame(spark, [(1, "a", None), (2, "b", None), (3, "c", 5)])
    up.upsert_table(first, path, ["id"], layout=layout)
    up.upsert_table(frame(spark, [(1, "A", None), (4, "d", None)]), path, ["id"], layout=layout)
    got = sorted(map(tuple, spark.read.parquet(path).select("id", "v").collect()))
    assert got == [(1, "A"), (2, "b"), (3, "c"), (4, "d")]


def test_foreign_table_is_taken_over_not_overwritten(spark, scratch):
    path = scratch("foreign")
    frame(spark, [(i, "old", 1) for i in range(100)]).write.parquet(path)
    with pytest.raises(ValueError):
        up.upsert_table(frame(spark, [(1, "new", 2)]), path, ["id"])  # the layout must be named
    assert up.upsert_table(frame(spark, [(1, "new", 2)]), path, ["id"], buckets=4)["mode"] == "taken over"
    got = {r.id: r.v for r in spark.read.parquet(path).collect()}
    assert len(got) == 100 and got[1] == "new" and got[2] == "old" and spark.read.parquet(path).count() == 100
    other = scratch("foreign_parts")
    frame(spark, [(1, "a", 1)]).write.partitionBy("ts").parquet(other)
    with pytest.raises(ValueError):
        up.upsert_table(frame(spark, [(1, "b", 2)]), other, ["id"], buckets=4)
    assert spark.read.parquet(other).count() == 1


def test_interrupted_take_over_is_finished(spark, scratch):
    path = scratch("foreign_crash")
    frame(spark, [(i, "old", 1) for i in range(10)]).write.parquet(path)
    staged = f"{path}/{up.STAGING}/crashed"
    frame(spark, [(i, "new", 2) for i in range(10)]).withColumn(up.BUCKET, up.bucket_of(["id"], 2)).write.partitionBy(up.BUCKET).parquet(staged)
    up.fs.write_text(spark, f"{staged}/{up.TAKEN_OVER}", "plain files")
    assert up.recover(spark, path) == 1
    got = spark.read.parquet(path)
    assert got.count() == 10 and {r.v for r in got.collect()} == {"new"}


@pytest.mark.parametrize("values", [["01", "02", "1e3", "A"], ["2024-01-01", None, "x=y/z"]])
def test_layout_texts_stay_texts(spark, scratch, values):
    path = scratch("texts")
    schema = "id long, part string, v string"
    rows = [(i, values[i % len(values)]) for i in range(12)]
    for v in ("a", "b", "c"):
        up.upsert_table(spark.createDataFrame([(i, p, v) for i, p in rows], schema), path, ["id"], layout=F.col("part"))
    up.upsert_table(spark.createDataFrame([(0, values[0], "d"), (99, values[-1], "d")], schema), path, ["id"], layout=F.col("part"))
    got = {r.id: (r.part, r.v) for r in spark.read.parquet(path).collect()}
    assert spark.read.parquet(path).count() == 13 == len(got)
    assert got[0] == (values[0], "d") and got[5] == (rows[5][1], "c")


def test_lost_marker_is_checked_against_the_rows(spark, scratch):
    path = scratch("lost")
    rows = [(i, "a", 1) for i in range(100)]
    up.upsert_table(frame(spark, rows), path, ["id"], buckets=16)
    up.fs.delete(spark, f"{path}/{up.LAYOUT_MARKER}")
    for wrong in (None, 64):
        with pytest.raises(ValueError):
            up.upsert_table(frame(spark, rows), path, ["id"], buckets=wrong)
    up.upsert_table(frame(spark, [(i, "b", 2) for i in range(100)]), path, ["id"], buckets=16)
    assert spark.read.parquet(path).count() == 100


def test_guarded_upsert_leaves_few_files_and_no_scratch(spark, scratch):
    path = scratch("files")
    up.upsert_table(spark.range(4000).select("id", F.lit("a").alias("v"), F.lit(1).alias("ts")), path, ["id"], buckets=8)
    half = spark.range(0, 4000, 2).select("id", F.lit("b").alias("v"), F.lit(2).alias("ts")).repartition(7)
    up.upsert_table(half, path, ["id"], guard="ts")
    files = spark.read.parquet(path).select(F.input_file_name()).distinct().count()
    assert files <= 16
    assert spark.read.parquet(path).where("v = 'b'").count() == 2000
    for hidden in (up.STAGING, up.BATCHES):
        assert up.fs.list_dirs(spark, f"{path}/{hidden}") == []


def test_creation_needs_a_layout(spark, scratch):
    with pytest.raises(ValueError):
        up.upsert_table(frame(spark, [(1, "a", 1)]), scratch("none"), ["id"])
    with pytest.raises(ValueError):
        up.upsert_table(frame(spark, [(1, "a", 1)]), scratch("delta"), ["id"], buckets=4, fmt="delta")


def _merged(spark, path):
    return as_set(spark.read.parquet(path))


@pytest.mark.parametrize("guard", [None, "ts"])
def test_batch_beyond_the_broadcast_bound_is_merged_by_groups(spark, scratch, capsys, guard):
    old = [(i, f"v{i}", i % 7) for i in range(900)]
    new = [(i, f"n{i}", 3) for i in range(600, 1200)] + [(None, "null", 1)]
    path, plain = scratch("grouped"), scratch("plain")
    for p in (path, plain):
        up.upsert_table(frame(spark, old), p, ["id"], buckets=16)
    info = up.upsert_table(frame(spark, new), path, ["id"], guard=guard, max_broadcast_rows=100)
    assert info["groups"] > 4 and info["buckets_touched"] == 16
    assert up.upsert_table(frame(spark, new), plain, ["id"], guard=guard)["groups"] == 1
    assert _merged(spark, path) == _merged(spark, plain)
    # a group's stored rows meet its batch keys where they are read
    group = up.bucket_groups({b: 40 for b in range(16)}, 100)[0]
    assert group == [0, 1]
    target = up._touched_partitions(spark, path, group, up._partition_values(spark, path))
    batch = frame(spark, new).withColumn(up.BUCKET, up.bucket_of(["id"], 16)).where(F.col(up.BUCKET).isin(group))
    capsys.readouterr()
    up.merge_frames(target, batch, ["id"], on_duplicate="keep", max_broadcast_rows=100).explain()
    text = capsys.readouterr().out
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text


def test_one_bucket_beyond_the_bound_shuffles_alone(spark, scratch):
    assert up.bucket_groups({0: 5, 1: 500, 2: 5, 3: 90}, 100) == [[0], [1], [2, 3]]
    path = scratch("one")
    up.upsert_table(frame(spark, [(i, "a", 1) for i in range(50)]), path, ["id"], buckets=2)
    info = up.upsert_table(frame(spark, [(i, "b", 2) for i in range(80)]), path, ["id"], max_broadcast_rows=10)
    assert info["groups"] == 2 and _merged(spark, path) == [(i, "b", 2) for i in range(80)]


def test_publishing_by_moving_and_by_copying_agree(spark, scratch, monkeypatch):
    rows, new = [(i, "a", 1) for i in range(60)], [(i, "b", 2) for i in range(40, 80)]
    tables = []
    for renames in (("file",), ()):
        monkeypatch.setattr(up, "RENAMES", renames)
        path = scratch("publish")
        up.upsert_table(frame(spark, rows), path, ["id"], buckets=4)
        up.upsert_table(frame(spark, new), path, ["id"])
        tables.append(_merged(spark, path))
        assert not up.fs.list_dirs(spark, f"{path}/{up.STAGING}")
    assert tables[0] == tables[1] == [(i, "a" if i < 40 else "b", 1 if i < 40 else 2) for i in range(80)]


def test_crash_between_two_moved_buckets_is_finished(spark, scratch, monkeypatch):
    path = scratch("moved")
    up.upsert_table(frame(spark, [(i, "a", 1) for i in range(60)]), path, ["id"], buckets=4)
    real, calls = up.fs.replace_dir, []

    def die(s, source, target):
        if calls:
            raise RuntimeError("driver lost")
        calls.append(target)
        real(s, source, target)

    monkeypatch.setattr(up.fs, "replace_dir", die)
    with pytest.raises(RuntimeError):
        up.upsert_table(frame(spark, [(i, "b", 2) for i in range(60)]), path, ["id"])
    monkeypatch.setattr(up.fs, "replace_dir", real)
    assert up.recover(spark, path) == 1
    assert _merged(spark, path) == [(i, "b", 2) for i in range(60)]


def test_delta_without_the_package_says_so(spark, scratch):
    with pytest.raises(ValueError, match="delta package"):
        up.upsert_table(frame(spark, [(1, "a", 1)]), scratch("delta"), ["id"], fmt="delta")


def test_delta_route_builds_the_merge(spark, scratch, monkeypatch):
    """The calls of the Delta branch, on a stand-in for the package that records them."""
    import sys
    import types

    log = []

    class Table:
        @staticmethod
        def isDeltaTable(_, path):
            return path.endswith("there")

        @staticmethod
        def forPath(_, path):
            return Table()

        def toDF(self):
            return frame(spark, [])

        def alias(self, name):
            return self

        def merge(self, source, cond):
            log.append((sorted(map(tuple, source.collect())), cond))
            return self

        def whenMatchedUpdateAll(self, condition=None):
            log.append(condition)
            return self

        def whenNotMatchedInsertAll(self):
            return self

        def execute(self):
            log.append("done")

    monkeypatch.setitem(sys.modules, "delta", types.ModuleType("delta"))
    tables = types.ModuleType("delta.tables")
    tables.DeltaTable = Table
    monkeypatch.setitem(sys.modules, "delta.tables", tables)
    info = up.upsert_table(frame(spark, [(1, "a", 1), (1, "b", 2)]), "/tables/there", ["id"], on_duplicate="latest", order_by=["ts"], guard="ts", fmt="delta")
    assert info == {"mode": "merge"}
    assert log == [([(1, "b", 2)], "target.`id` = source.`id`"), "target.`ts` IS NULL OR source.`ts` >= target.`ts`", "done"]
    with pytest.raises(ValueError, match="parquet form"):
        up.upsert_table(frame(spark, []), "/tables/there", ["id"], buckets=4, fmt="delta")
