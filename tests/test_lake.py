from pyspark.sql import functions as F

from stratum.sources import landing
from stratum.sources.lake import read_path, table_exists, write_table
from stratum.operators import upsert as up
from tests.conftest import SMALL


def test_overwrite_keeps_old_columns_as_null(spark, scratch):  # Q8
    path = scratch("gold")
    write_table(spark.createDataFrame([(1, "a", 1.0)], "id int, name string, score double"), path)
    write_table(spark.createDataFrame([(2, "b", True)], "id int, name string, flag boolean"), path)
    rows = read_path(spark, path).collect()
    assert len(rows) == 1
    assert rows[0].asDict() == {"id": 2, "name": "b", "flag": True, "score": None}


def test_table_exists(spark, scratch):  # S6
    path = scratch("t")
    assert not table_exists(spark, path)
    write_table(spark.range(3), path)
    assert table_exists(spark, path)


def test_partitioned_read_back_keeps_string_key(spark, scratch):  # Q9
    path = scratch("p")
    df = spark.createDataFrame([("20240101", 1), ("20240102", 2)], "date_key string, v int")
    write_table(df, path, partition_cols=["date_key"])
    assert dict(read_path(spark, path).dtypes)["date_key"] == "int"  # inferred: the pitfall
    assert dict(read_path(spark, path, schema=df.schema).dtypes)["date_key"] == "string"


def test_landing_appends_with_source_file(spark, scratch):  # R1
    path = scratch("bronze")
    src = f"{SMALL}/region.parquet"
    landing.land_batch(spark, src, path)
    landing.land_batch(spark, src, path)
    landed = spark.read.parquet(path)
    assert landed.count() == 10
    assert {r[0] for r in landed.select(landing.file_name()).distinct().collect()} == {"region.parquet"}
    assert set(landed.columns) >= {"r_regionkey", "r_name", landing.SOURCE_FILE, landing.INGESTED_AT}



def test_landing_a_batch_again_replaces_it(spark, scratch):  # R1, retried job
    path = scratch("bronze_batches")
    src = f"{SMALL}/region.parquet"
    landing.land_batch(spark, src, path, batch_id="b1")
    landing.land_batch(spark, src, path, batch_id="b2")
    landing.land_batch(spark, src, path, batch_id="b1")  # the retry
    counts = {r[0]: r[1] for r in spark.read.parquet(path).groupBy(landing.LANDING_BATCH).count().collect()}
    assert counts == {"b1": 5, "b2": 5}

def test_upsert_reports_rows_in_touched_partitions(spark, scratch):
    path = scratch("u")
    up.upsert_table(spark.range(20).withColumn("v", F.lit(0)), path, ["id"], buckets=4)
    info = up.upsert_table(spark.range(3).withColumn("v", F.lit(1)), path, ["id"], buckets=4)
    touched = spark.read.parquet(path).where(F.col(up.BUCKET).isin(
        [r[0] for r in spark.range(3).select(up.bucket_of(["id"], 4)).distinct().collect()])).count()
    assert info["rows_in_touched"] == touched


def test_gold_overwrite_is_full_even_with_dynamic_session_mode(spark, scratch):  # S4
    path = scratch("full_overwrite")
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_table(spark.createDataFrame([("20240101", 1), ("20240102", 2)], "date_key string, v int"), path,
                    partition_cols=["date_key"])
        write_table(spark.createDataFrame([("20240103", 3)], "date_key string, v int"), path,
                    partition_cols=["date_key"])
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    assert [r.v for r in spark.read.parquet(path).collect()] == [3]


def test_partitioned_overwrite_keeps_old_columns_from_one_folder(spark, scratch):  # Q8, S7
    from stratum.sources.lake import existing_schema

    path = scratch("merge_partitioned")
    write_table(spark.createDataFrame([("20240101", 1, "x"), ("20240102", 2, "y")], "date_key string, v int, old string"),
                path, partition_cols=["date_key"])
    assert set(existing_schema(spark, path).fieldNames()) == {"v", "old", "date_key"}
    write_table(spark.createDataFrame([("20240103", 3)], "date_key string, v int"), path, partition_cols=["date_key"])
    got = spark.read.parquet(path)
    assert sorted(got.columns) == ["date_key", "old", "v"]
    assert [(r.v, r.old) for r in got.collect()] == [(3, None)]
    assert existing_schema(spark, scratch("absent")) is None
