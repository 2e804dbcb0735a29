import pytest
from pyspark.sql.types import IntegerType, StringType, StructType

from stratum.operators.conform import AUDIT_COLUMN, clean, dedup_latest, enforce_schema, stamp


def schema():
    return StructType().add("id", StringType(), False).add("value", IntegerType(), True)


def test_permissive_cast_nulls_bad_values(spark):  # Q1
    df = spark.createDataFrame([("1", "12x"), ("2", "7")], ["id", "value"])
    rows = {r["id"]: r["value"] for r in enforce_schema(df, schema()).collect()}
    assert rows == {"1": None, "2": 7}


def test_strict_cast_fails_on_bad_values(spark):  # Q1
    df = spark.createDataFrame([("1", "12x")], ["id", "value"])
    with pytest.raises(Exception):
        enforce_schema(df, schema(), mode="strict").collect()



def test_strict_cast_fails_without_ansi_too(spark):  # Q1, a cluster with ANSI off
    df = spark.createDataFrame([("1", "12x")], ["id", "value"])
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="cannot cast value"):
            enforce_schema(df, schema(), mode="strict").collect()
        good = spark.createDataFrame([("1", "7"), ("2", None)], ["id", "value"])
        assert sorted(r["value"] or 0 for r in enforce_schema(good, schema(), mode="strict").collect()) == [0, 7]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)

def test_nullability_is_not_enforced(spark):  # Q2
    df = spark.createDataFrame([(None, "1")], "id string, value string")
    out = enforce_schema(df, schema())
    assert out.schema["id"].nullable
    assert out.first()["id"] is None


def test_missing_column_raises(spark):
    with pytest.raises(ValueError):
        enforce_schema(spark.createDataFrame([("1",)], ["id"]), schema())


def test_audit_column_lost_by_enforcement_unless_restamped(spark):  # Q3
    df = spark.createDataFrame([("1", "5")], ["id", "value"])
    enforced = enforce_schema(clean(df, dedup_keys=("id",)), schema())
    assert AUDIT_COLUMN not in enforced.columns
    assert AUDIT_COLUMN in stamp(enforced).columns


def test_dedup_is_skipped_without_key_columns(spark):  # P5
    df = spark.createDataFrame([("a",), ("a",)], ["name"])
    assert clean(df).count() == 2


def test_exact_dedup_keeps_two_spellings_of_one_instant(spark):  # Q4
    df = spark.createDataFrame([("1", "2023-01-01 10:00:00"), ("1", "2023-01-01T10:00:00")], ["id", "updated_at"])
    assert clean(df).count() == 2


def test_dedup_latest_is_deterministic(spark):
    rows = [(1, 5, "b"), (1, 5, "a"), (1, 3, "z"), (2, 1, "x"), (None, 1, "n"), (None, 2, "m")]
    df = spark.createDataFrame(rows, "k int, ts int, v string")
    for parts in (1, 3, 7):
        got = sorted(map(tuple, dedup_latest(df.repartition(parts), ["k"], ["ts"]).collect()),
                     key=lambda r: (r[0] is None, r))
        assert got == [(1, 5, "b"), (2, 1, "x"), (None, 2, "m")]
