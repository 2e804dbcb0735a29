import time

from pyspark.sql.types import StringType, StructField, StructType

from stratum.streaming import bronze_stream as bs

SCHEMA = StructType([StructField(c, StringType()) for c in ("id", "updated_at", "v")])


def test_late_rows_dropped_with_short_delay(spark, scratch):  # R2
    root = scratch("late")
    early = [("1", "2024-01-10 00:00:00", "a"), ("1", "2024-01-10 00:00:00", "a")]
    # late rows are judged against the previous micro-batch's watermark, so the
    # late row arrives two batches after the one that moved the watermark
    arrivals = [early, [("2", "2024-01-20 00:00:00", "b")], [("4", "2024-01-20 00:00:01", "c")],
                [("3", "2024-01-11 00:00:00", "late")]]
    for rows in arrivals:  # one file each, in this order (the source orders files by modification time)
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
        time.sleep(1.1)
    stream = bs.read_arrivals(spark, f"{root}/in", SCHEMA, max_files_per_trigger=1)
    bs.run_available(bs.dedup_within_watermark(stream, "updated_at", "1 day", ["id", "updated_at"]),
                     f"{root}/out", f"{root}/ckpt")
    ids = sorted(r.id for r in spark.read.schema(SCHEMA).parquet(f"{root}/out").collect())
    assert ids == ["1", "2", "4"]  # copy dropped, row 9 days behind the watermark dropped


def test_stream_upsert_replay_is_idempotent(spark, scratch):  # R3
    root = scratch("replay")
    rows = [("1", "2024-01-01 00:00:00", "a"), ("1", "2024-01-02 00:00:00", "b"), ("2", "2024-01-01 00:00:00", "c")]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{root}/in")
    target_schema = StructType([StructField("id", StringType()), StructField("updated_at", StringType()),
                                StructField("v", StringType())])
    for run in (1, 2):  # second run: a fresh checkpoint replays every file
        stream = bs.read_arrivals(spark, f"{root}/in", SCHEMA, max_files_per_trigger=1)
        bs.run_stream_upsert(stream, f"{root}/silver", f"{root}/ckpt{run}", ["id"], ["updated_at"],
                             schema=target_schema, guard="updated_at", buckets=4)
        got = sorted((r.id, r.v) for r in spark.read.parquet(f"{root}/silver").collect())
        assert got == [("1", "b"), ("2", "c")]


def test_stream_upsert_keeps_every_null_key_row(spark, scratch):  # R3, Q6
    root = scratch("nullkeys")
    rows = [(None, "2024-01-01 00:00:00", "a"), (None, "2024-01-02 00:00:00", "b"),
            ("1", "2024-01-01 00:00:00", "c"), ("1", "2024-01-03 00:00:00", "d")]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{root}/in")
    stream = bs.read_arrivals(spark, f"{root}/in", SCHEMA)
    bs.run_stream_upsert(stream, f"{root}/silver", f"{root}/ckpt", ["id"], ["updated_at"], buckets=4)
    got = sorted((r.id or "", r.v) for r in spark.read.parquet(f"{root}/silver").collect())
    assert got == [("", "a"), ("", "b"), ("1", "d")]


def test_late_first_copy_does_not_hide_the_one_in_time(spark, scratch):
    """Keys without the event time: a copy behind the watermark is dropped and counted, the later copy in time stays;
    wide integers with nulls and far timestamps pass unchanged."""
    root = scratch("late")
    schema = "id string, updated_at string, n long"
    big = 9007199254740993
    batches = [[("a", "2024-01-10 00:00:00", big)], [("b", "2024-01-10 01:00:00", None)],
               [("c", "2024-01-01 00:00:00", 1), ("c", "2024-01-10 02:00:00", big)], [("d", "9999-12-31 00:00:00", None), ("e", "soon", 2)]]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = bs.read_arrivals(spark, f"{root}/in", spark.createDataFrame([], schema).schema, max_files_per_trigger=1)
    good, bad = bs.split_unparseable(stream, "updated_at")
    seen = bs.run_available(bs.dedup_within_watermark(good, "updated_at", "1 day", ["id"]), f"{root}/out", f"{root}/c1")
    bs.run_available(bad, f"{root}/bad", f"{root}/c2")
    got = {r.id: r.n for r in spark.read.parquet(f"{root}/out").collect()}
    assert got == {"a": big, "b": None, "c": big, "d": None} and seen["late"] == 1
    assert [r.id for r in spark.read.parquet(f"{root}/bad").collect()] == ["e"]


def test_hot_group_of_copies_comes_out_once(spark, scratch):  # R2
    root = scratch("hotcopies")
    rows = [("7", "2024-01-10 00:00:00", "hot")] * 3000 + [(str(i), "2024-01-10 00:00:00", "x") for i in range(100)]
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{root}/in")
    stream = bs.read_arrivals(spark, f"{root}/in", SCHEMA, max_files_per_trigger=2)
    bs.run_available(bs.dedup_within_watermark(stream, "updated_at", "1 day", ["id", "updated_at"]), f"{root}/out", f"{root}/ckpt")
    got = spark.read.schema(SCHEMA).parquet(f"{root}/out")
    assert got.count() == 100 and got.where("id = '7'").count() == 1


def test_every_delivered_row_lands_somewhere(spark, scratch):
    """Kept, late and unparseable rows and re-deliveries add up; a replayed micro-batch changes nothing."""
    from pyspark.sql import functions as F

    root = scratch("land")
    rounds = [[("1", "2024-01-10 00:00:00", "a"), ("1", "2024-01-10 00:00:00", "a"), (None, "2024-01-10 00:00:00", "n"), ("8", "soon", "x")],
              [("2", "2024-01-20 00:00:00", "b"), ("1", "2024-01-10 00:00:00", "a")],
              [("3", "2024-01-11 00:00:00", "late"), ("2", "2024-01-20 00:00:00", "b"), (None, "2024-01-19 12:00:00", "n"), ("9", None, None)],
              [("4", "2024-01-19 00:00:00", "in time"), ("5", "2024-01-18 23:59:59", "late")]]
    for k, rows in enumerate(rounds):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
        bs.land_stream(bs.read_arrivals(spark, f"{root}/in", SCHEMA), f"{root}/out", f"{root}/ckpt", "updated_at", "1 day", ["id", "updated_at"])
    parts = {p: sorted((r.id or "", r.v or "") for r in bs.read_landed(spark, f"{root}/out", SCHEMA, p).collect()) for p in (bs.KEPT, bs.LATE, bs.UNPARSEABLE)}
    assert parts[bs.KEPT] == [("", "n"), ("", "n"), ("1", "a"), ("2", "b"), ("4", "in time")]
    # the second batch's copy of 1 is behind the first batch's mark only once that has moved on
    assert parts[bs.LATE] == [("3", "late"), ("5", "late")] and parts[bs.UNPARSEABLE] == [("8", "x"), ("9", "")]
    apply = bs.land_batches(f"{root}/out", f"{root}/ckpt", "updated_at", "1 day", ["id", "updated_at"])
    before = sorted(map(str, spark.read.parquet(f"{root}/out").collect()))
    for k, rows in reversed(list(enumerate(rounds))):
        apply(spark.createDataFrame(rows, SCHEMA), k)
    assert sorted(map(str, spark.read.parquet(f"{root}/out").collect())) == before
    assert bs.read_landed(spark, f"{root}/out", SCHEMA, bs.KEPT).where(F.col("v") == "late").count() == 0


def _fresh(spark, root, rounds, pause=0.0, **options):
    """Rows that ``newest_versions`` gives out for each round of arrivals, and the state rows afterwards."""
    out, state = [], 0
    for rows in rounds:
        time.sleep(pause)
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
        out.append([])
        newest = bs.newest_versions(bs.read_arrivals(spark, f"{root}/in", SCHEMA), ["id"], "updated_at", **options)
        writer = newest.writeStream.foreachBatch(lambda df, _: out[-1].extend((r.id, r.updated_at, r.v) for r in df.collect()))
        with bs._no_empty_batches(spark):
            query = writer.outputMode("update").option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start()
        query.awaitTermination()
        state = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    return [sorted(rows, key=str) for rows in out], state


def test_newest_version_state_is_held_by_groups_of_keys(spark, scratch, monkeypatch):
    """A state row and a Python call for a group of keys, not for each key; every key is judged alone."""
    monkeypatch.setattr(bs, "_STATE_CHUNK", 50)  # a group's rows are reduced in several steps
    first = [(str(i), "2024-01-05", f"v{i % 7}") for i in range(400)] + [(str(i), "2024-01-04", "old") for i in range(0, 400, 3)]
    second = [(str(i), "2024-01-04", "old") for i in range(400)] + [("5", "2024-01-05", "v5"), ("6", "2024-01-05", "v7"), ("7", "2024-01-05", None),
                                                                    ("8", "2024-01-06", None), ("9", "2024-01-06", "a"), ("9", "2024-01-06", "b")]
    (one, two), state = _fresh(spark, scratch("groups"), [first, second], groups=4)
    assert one == sorted(((str(i), "2024-01-05", f"v{i % 7}") for i in range(400)), key=str)
    assert two == [("6", "2024-01-05", "v7"), ("8", "2024-01-06", None), ("9", "2024-01-06", "b")]
    assert state == 4


def test_newest_version_state_forgets_a_key_after_its_time(spark, scratch):
    rounds = [[("1", "2024-01-05", "new")], [("2", "2024-01-05", "x")], [("1", "2024-01-01", "old")]]
    assert _fresh(spark, scratch("kept"), rounds, groups=1)[0][2] == []
    assert _fresh(spark, scratch("timed"), rounds, pause=1.5, groups=1, keep="1 second")[0][2] == [("1", "2024-01-01", "old")]


def test_first_upsert_of_a_batch_runs_its_plan_once(spark, scratch):
    root, calls = scratch("once"), spark.sparkContext.accumulator(0)

    def counted(batches):
        for pdf in batches:
            calls.add(len(pdf))
            yield pdf

    batch = spark.createDataFrame([("1", "2024-01-01", "a"), ("2", "2024-01-01", "b"), (None, "2024-01-01", "n")], SCHEMA).coalesce(1)
    bs.upsert_batches(f"{root}/silver", ["id"], ["updated_at"], buckets=2)(batch.mapInPandas(counted, SCHEMA), 0)
    assert calls.value == 3
    assert spark.read.parquet(f"{root}/silver").count() == 3


def test_newest_version_in_state_ignores_arrival_order(spark, scratch, monkeypatch):
    root = scratch("newest")
    rounds = [[("1", "2024-01-03", "new"), ("2", "2024-01-01", "x"), (None, "2024-01-01", "null key")],
              [("1", "2024-01-01", "old"), ("2", "2024-01-02", "y"), ("2", "2024-01-02", "z"), ("3", None, "no version")],
              [("1", "2024-01-02", "older"), ("4", "2024-01-01", None)]]
    written = []
    real = bs.upsert_table

    def seen(df, *args, **options):
        written.append(sorted((r.id or "", r.v or "") for r in df.collect()))
        return real(df, *args, **options)

    monkeypatch.setattr(bs, "upsert_table", seen)
    for rows in rounds:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
        bs.run_stream_upsert_newest(bs.read_arrivals(spark, f"{root}/in", SCHEMA), f"{root}/silver", f"{root}/ckpt", ["id"], "updated_at", buckets=2)
    got = sorted((r.id or "", r.v or "") for r in spark.read.parquet(f"{root}/silver").collect())
    assert got == [("", "null key"), ("1", "new"), ("2", "z"), ("3", "no version"), ("4", "")]
    stored = [x for rows in written for x in rows]
    assert ("1", "old") not in stored and ("1", "older") not in stored and ("2", "y") not in stored  # no stale version reaches storage
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"
