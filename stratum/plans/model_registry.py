"""Fitted demand models as a table beside their folders (R8), and predictions that name the version that made them.

``<root>/<name>/version=<n>`` holds a fitted pipeline, ``<root>/<name>/models`` one row a version – parameters,
coefficients, held-out error, a fingerprint of the training rows – and ``<root>/<name>/promotions`` one row a
promotion. Nothing is overwritten: the newest promotion is the one that holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.plans.forecast import FEATURES, load_model, predict, save_model, training_rows
from stratum.sources import fs

MODELS, PROMOTIONS = "models", "promotions"


def training_fingerprint(features: DataFrame, feature_cols: Sequence[str] = FEATURES) -> DataFrame:
    """(training_rows, first_month, last_month, fingerprint) of the rows a model is fitted on: one row.

    The fingerprint is the MD5 of the row count, the months and the exact sums of label and features in cents, so it
    is the same for the same rows in any order."""
    rows = training_rows(features, feature_cols)
    cents = [F.sum(F.round(F.col(c) * 100).cast("decimal(38,0)")).cast("string").alias(f"s{i}") for i, c in enumerate(["label", *feature_cols])]
    sums = rows.agg(F.count(F.lit(1)).alias("training_rows"), F.min("year_month").alias("first_month"), F.max("year_month").alias("last_month"), *cents)
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sums.columns]
    return sums.select("training_rows", "first_month", "last_month", F.md5(F.concat_ws("|", *parts).cast("binary")).alias("fingerprint"))


def versions(spark: SparkSession, root: str, name: str) -> list[int]:
    found = [d.rsplit("/", 1)[-1] for d in fs.list_dirs(spark, f"{root}/{name}")]
    return sorted(int(d.split("=", 1)[1]) for d in found if d.startswith("version="))


def register_model(model: PipelineModel, root: str, name: str, features: DataFrame, params: dict, rmse: float | None = None,
                   feature_cols: Sequence[str] = FEATURES) -> int:
    """Save a fitted pipeline under the next version and add its row to the model table; returns the version.

    The folder comes first, so a row without a model cannot appear. One writer a model name."""
    spark = features.sparkSession
    version = max(versions(spark, root, name), default=0) + 1
    place = save_model(model, f"{root}/{name}", str(version))
    lr = model.stages[-1]
    weights = [x for c, w in zip(feature_cols, lr.coefficients, strict=True) for x in (F.lit(c), F.lit(float(w)))]
    row = training_fingerprint(features, feature_cols).select(
        F.lit(name).alias("name"), F.lit(version).alias("version"), F.lit(float(params["alpha"])).alias("alpha"),
        F.lit(float(params["l1_ratio"])).alias("l1_ratio"), F.lit(float(lr.intercept)).alias("intercept"), F.create_map(*weights).alias("coefficients"),
        F.lit(rmse).cast("double").alias("rmse"), "training_rows", "first_month", "last_month", "fingerprint",
        F.lit(place).alias("path"), F.current_timestamp().alias("created_at"))
    row.coalesce(1).write.mode("append").parquet(f"{root}/{name}/{MODELS}")
    return version


def promote_model(spark: SparkSession, root: str, name: str, version: int) -> None:
    """Make ``version`` the one that predictions are made with."""
    if version not in versions(spark, root, name):
        raise ValueError(f"model {name!r} has no version {version}")
    path = f"{root}/{name}/{PROMOTIONS}"
    turn = spark.read.parquet(path).agg(F.max("turn")).first()[0] + 1 if fs.exists(spark, path) else 1
    spark.range(1).select(F.lit(turn).alias("turn"), F.lit(version).alias("version"), F.current_timestamp().alias("promoted_at")).coalesce(1) \
        .write.mode("append").parquet(path)


def promoted_version(spark: SparkSession, root: str, name: str) -> int | None:
    path = f"{root}/{name}/{PROMOTIONS}"
    return spark.read.parquet(path).agg(F.max_by("version", "turn")).first()[0] if fs.exists(spark, path) else None


def model_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One row a version, with ``promoted`` true for the one in use."""
    now = promoted_version(spark, root, name)
    return spark.read.parquet(f"{root}/{name}/{MODELS}").withColumn("promoted", F.col("version").eqNullSafe(F.lit(now).cast("int")))


def predict_promoted(features: DataFrame, root: str, name: str, keys: Sequence[str] = ("store_id", "product_id"),
                     feature_cols: Sequence[str] = FEATURES) -> DataFrame:
    """R9 with the promoted model; every row carries ``model_name`` and ``model_version``."""
    spark = features.sparkSession
    version = promoted_version(spark, root, name)
    if version is None:
        raise ValueError(f"no version of model {name!r} is promoted")
    out = predict(load_model(f"{root}/{name}", str(version)), features, keys, feature_cols)
    return out.withColumns({"model_name": F.lit(name), "model_version": F.lit(version)})
