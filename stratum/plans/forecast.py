"""Demand features and an elastic-net demand model.

Features are calendar-exact: a month index is derived from ``year_month``
and every lag / rolling frame is a RANGE frame over that index, so a missing
month stays missing instead of shifting the series. Each window partition is
one (store, product) series of monthly rows, so its size is bounded by the
number of months, however hot a store or product is in the raw data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.sources.lake import write_table

MONTH_INDEX = "month_index"


def month_index(year_month: str = "year_month"):
    ym = F.col(year_month)
    return F.substring(ym, 1, 4).cast("int") * 12 + F.substring(ym, 5, 2).cast("int") - 1


def demand_features(monthly: DataFrame, keys: Sequence[str] = ("store_id", "product_id"),
                    value_col: str = "monthly_revenue", lags: Sequence[int] = (1, 2, 3),
                    rolling: int = 3) -> DataFrame:
    """Per series and month, the value ``k`` months earlier (null when that
    month had no sales) and the mean over the previous ``rolling`` months that
    had sales. Lags over rows, matched by their distance in months; sums run on whole cents, so the order of
    the additions does not show. Amounts that cents in a long cannot hold (NaN, infinities, beyond 9e13) are summed
    as doubles and fail no run, as in the monthly aggregate."""
    base = monthly.select(*keys, "year_month", month_index().alias(MONTH_INDEX),
                          F.col(value_col).alias("label"))
    reach = max([*lags, rolling])
    w = Window.partitionBy(*keys).orderBy(MONTH_INDEX)
    # months of a series are distinct, so one that lies k months back is among the k rows before
    back = [F.struct((F.col(MONTH_INDEX) - F.lag(MONTH_INDEX, i).over(w)).alias("ago"),
                     F.lag(F.col("label").cast("double"), i).over(w).alias("value")) for i in range(1, reach + 1)]
    rows = base.withColumns({f"_b{i}": x for i, x in enumerate(back)})

    def at(k: int) -> Column:
        return F.coalesce(*[F.when(F.col(f"_b{i}.ago") == k, F.col(f"_b{i}.value")) for i in range(reach)])

    near = [F.when(F.col(f"_b{i}.ago") <= rolling, F.col(f"_b{i}.value")) for i in range(reach)]
    cents, plain, n, wild = F.lit(0).cast("long"), F.lit(0.0), F.lit(0), F.lit(False)
    for x in near:
        odd = F.coalesce(F.isnan(x) | (F.abs(x) > F.lit(9e13)), F.lit(False))
        cents = cents + F.when(odd | x.isNull(), F.lit(0).cast("long")).otherwise(F.rint(x * 100).cast("long"))
        plain, n, wild = plain + F.coalesce(x, F.lit(0.0)), n + x.isNotNull().cast("int"), wild | odd
    total = F.when(wild, plain).otherwise((cents / 100).cast("double"))
    mean = F.when(n > 0, total / n).alias(f"rolling_mean_{rolling}")
    month_of_year = (F.col(MONTH_INDEX) % 12 + 1).alias("month_of_year")
    return rows.select(*keys, "year_month", MONTH_INDEX, "label", *[at(k).alias(f"lag_{k}") for k in lags],
                       mean, month_of_year)


def with_next_month(monthly: DataFrame, keys: Sequence[str] = ("store_id", "product_id"),
                    value_col: str = "monthly_revenue") -> DataFrame:
    """``(keys, year_month, value)`` plus, for every series, the month after the last month of the whole table, without a value."""
    rows = monthly.select(*keys, "year_month", value_col)
    last = rows.agg(F.max("year_month")).first()[0]
    if last is None:
        return rows
    n = int(last[:4]) * 12 + int(last[4:6])
    ahead = rows.select(*keys).distinct().withColumn("year_month", F.lit(f"{n // 12:04d}{n % 12 + 1:02d}"))
    return rows.unionByName(ahead.withColumn(value_col, F.lit(None).cast(rows.schema[value_col].dataType)))


def elastic_net_params(alpha: float, l1_ratio: float, label_std: float) -> tuple[float, float]:
    """Q12: map the textbook elastic net
    ``1/(2n)||y-Xw||² + alpha*l1_ratio*|w|₁ + alpha*(1-l1_ratio)/2*||w||²``
    to MLlib's ``(regParam, elasticNetParam)``. MLlib fits on the label
    divided by its standard deviation, which scales the L2 part by that
    deviation; with ``standardization=False`` this mapping is exact."""
    l1 = alpha * l1_ratio
    l2 = alpha * (1.0 - l1_ratio) * label_std
    reg = l1 + l2
    return reg, (l1 / reg if reg > 0 else 0.0)


FEATURES = ("lag_1", "lag_2", "lag_3", "rolling_mean_3", "month_of_year")


def training_rows(features: DataFrame, feature_cols: Sequence[str] = FEATURES) -> DataFrame:
    """Rows where the label and every feature are known."""
    return features.na.drop(subset=["label", *feature_cols])


def train_demand_model(features: DataFrame, alpha: float = 0.5, l1_ratio: float = 0.2,
                       feature_cols: Sequence[str] = FEATURES, max_iter: int = 100) -> PipelineModel:
    """Elastic-net linear regression of ``label`` on the features. The
    optimiser runs distributed (tree aggregation over partitions); only the
    coefficient vector lives on the driver."""
    rows = training_rows(features, feature_cols)
    std = rows.agg(F.stddev_samp("label")).first()[0]
    std = std if std is not None and not math.isnan(std) and std > 0 else 1.0
    reg, enet = elastic_net_params(alpha, l1_ratio, std)
    assembler = VectorAssembler(inputCols=list(feature_cols), outputCol="features")
    lr = LinearRegression(featuresCol="features", labelCol="label", regParam=reg, elasticNetParam=enet,
                          standardization=False, fitIntercept=True, maxIter=max_iter, tol=1e-9)
    model = Pipeline(stages=[assembler, lr]).fit(rows)
    if model.stages[-1].summary.totalIterations >= max_iter:
        raise RuntimeError(f"the optimiser did not converge in {max_iter} iterations")
    return model


def save_model(model: PipelineModel, path: str, version: str) -> str:
    """Persist the fitted pipeline under a name (a path) and a version; an existing version is never overwritten."""
    place = f"{path}/version={version}"
    model.write().save(place)
    return place


def load_model(path: str, version: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/version={version}")


def predict(model: PipelineModel, features: DataFrame, keys: Sequence[str] = ("store_id", "product_id"),
            feature_cols: Sequence[str] = FEATURES) -> DataFrame:
    """One row for every row of ``features``. Months whose label is not known yet are
    predicted too; where a feature is unknown the prediction is null and ``reason`` names the first one missing."""
    missing = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"{c} unknown")) for c in feature_cols])
    filled = features.withColumn("reason", missing).na.fill(0.0, subset=list(feature_cols))
    scored = model.transform(filled)
    return scored.select(*keys, "year_month", "label", F.when(F.col("reason").isNull(), F.col("prediction")).alias("prediction"), "reason")


def optimality(model: PipelineModel, features: DataFrame, alpha: float = 0.5, l1_ratio: float = 0.2,
               feature_cols: Sequence[str] = FEATURES, tolerance: float = 1e-3) -> DataFrame:
    """(coefficient, optimal): whether each coefficient meets the elastic net's first-order condition
    – the correlation with the residual equals the penalty's slope, or stays below it where the coefficient is zero."""
    rows = training_rows(features, feature_cols)
    lr = model.stages[-1]
    weights = [float(x) for x in lr.coefficients]
    fitted = F.lit(float(lr.intercept))
    for c, w in zip(feature_cols, weights, strict=True):
        fitted = fitted + F.col(c) * w
    rest = F.col("label") - fitted
    means = rows.agg(*[F.avg(F.col(c) * rest).alias(c) for c in feature_cols], F.avg(rest).alias("intercept"),
                     F.stddev("label").alias("scale"), *[F.stddev(c).alias(f"_{c}") for c in feature_cols])
    out = [F.struct(F.lit("intercept").alias("coefficient"), (F.abs("intercept") <= tolerance * F.col("scale")).alias("optimal"))]
    for c, w in zip(feature_cols, weights, strict=True):
        slope = F.col(c) - alpha * (1 - l1_ratio) * w
        bound = alpha * l1_ratio
        miss = F.abs(slope - bound * (1 if w > 0 else -1)) if w else F.greatest(F.abs(slope) - bound, F.lit(0.0))
        out.append(F.struct(F.lit(c).alias("coefficient"), (miss <= tolerance * F.col("scale") * F.col(f"_{c}")).alias("optimal")))
    return means.select(F.inline(F.array(*out)))


def write_predictions(predictions: DataFrame, path: str, fmt: str = "parquet") -> None:
    write_table(predictions, path, fmt)
