"""Cleaning and enforcement on one small dirty batch: which rows survive, as what."""

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampType

from stratum.operators.conform import AUDIT_COLUMN, clean, dedup_latest, enforce_schema

ORDERS = StructType([StructField("id", LongType(), False), StructField("city", StringType()),
                     StructField("items", IntegerType()), StructField("updated_at", TimestampType())])
RAW = [("17", "Oslo", "4", "2022-03-05 08:30:00", "left"), ("18", None, "four", "not a time", "right"),
       ("x9", "Rome", " 7 ", "2022-03-05", None), (None, "Bern", "2147483648", "2022-03-05 08:30:00", "")]


def test_enforcement_casts_every_value_or_nulls_it(spark):
    raw = spark.createDataFrame(RAW, "id string, city string, items string, updated_at string, side string")
    out = enforce_schema(raw.select("side", "updated_at", "items", "id", "city"), ORDERS)
    assert [(f.name, f.dataType) for f in out.schema.fields] == [(f.name, f.dataType) for f in ORDERS.fields]
    got = {r.city: (r.id, r.items, r.updated_at) for r in out.collect()}
    assert got["Oslo"] == (17, 4, datetime(2022, 3, 5, 8, 30)) and got[None] == (18, None, None)
    assert got["Rome"] == (None, 7, datetime(2022, 3, 5)) and got["Bern"][:2] == (None, None)


def test_cleaning_keeps_versions_and_drops_deliveries(spark):
    rows = [(1, "v1", 10), (1, "v1", 10), (1, "v2", 20), (2, "w", 5), (None, "n", 1), (None, "n", 1)]
    df = spark.createDataFrame(rows, "id long, name string, updated_at int")
    kept = clean(df, ["id", "updated_at"])
    assert sorted((r.id or 0, r.name) for r in kept.collect()) == [(0, "n"), (1, "v1"), (1, "v2"), (2, "w")]
    assert {(r.id, r.name) for r in dedup_latest(df.where("id is not null"), ["id"], ["updated_at"]).collect()} == {(1, "v2"), (2, "w")}


def test_the_stamp_is_one_value_for_a_run(spark):
    at = F.lit("2022-03-05 08:30:00").cast("timestamp")
    df = spark.range(1000).withColumn("updated_at", F.lit(1)).repartition(7)
    stamps = clean(df, ["id", "updated_at"], at=at).select(AUDIT_COLUMN).distinct().collect()
    assert [r[0] for r in stamps] == [datetime(2022, 3, 5, 8, 30)]
    assert clean(df, ["id", "updated_at"]).select(AUDIT_COLUMN).distinct().count() == 1
