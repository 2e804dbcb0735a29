"""Choice of the demand model's penalties on time-ordered folds.

Each fold trains on all months before its validation months, so no fold sees a later month. The whole grid is scored from
one table of sums per month – counts, sums and products of the features and the label, one partially aggregated pass over
the rows – because an elastic net needs no more than those: a fold's training sums are those of its months added up. The
table has one row a month, so scoring a grid of any size costs no further pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.plans.forecast import FEATURES, MONTH_INDEX, training_rows

ALPHAS, L1_RATIOS = (0.05, 0.5, 5.0, 50.0), (0.2, 0.8)
FOLDS = 3


def fold_bounds(n_months: int, n_folds: int = FOLDS) -> list[tuple[int, int]]:
    """(first, end) positions of each fold's validation months among the sorted months: blocks of equal length at the end."""
    n_folds = min(n_folds, n_months - 1)
    if n_folds < 1:
        raise ValueError("time-ordered folds need training rows of at least two months")
    width = n_months // (n_folds + 1)
    return [(n_months - (n_folds - k) * width, n_months - (n_folds - k - 1) * width) for k in range(n_folds)]


def fold_months(features: DataFrame, n_folds: int = FOLDS, feature_cols: Sequence[str] = FEATURES) -> DataFrame:
    """(fold, role, year_month, rows): which months each fold trains on and validates, as a table."""
    months = training_rows(features, feature_cols).groupBy(MONTH_INDEX, "year_month").agg(F.count(F.lit(1)).alias("rows"))
    # one row a month from here on
    placed = months.withColumn("at", F.row_number().over(Window.orderBy(MONTH_INDEX)) - 1)
    bounds = fold_bounds(months.count(), n_folds)
    roles = [F.struct(F.lit(k).alias("fold"), F.when(F.col("at") < a, "train").when(F.col("at") < b, "validate").alias("role"))
             for k, (a, b) in enumerate(bounds, 1)]
    return placed.select("year_month", "rows", F.inline(F.array(*roles))).where(F.col("role").isNotNull()).select("fold", "role", "year_month", "rows")


@dataclass(frozen=True)
class Sums:
    """Sums over rows of (1, features, label) and of their products."""

    n: float
    first: np.ndarray
    second: np.ndarray

    def __add__(self, other: Sums) -> Sums:
        return Sums(self.n + other.n, self.first + other.first, self.second + other.second)


def monthly_sums(features: DataFrame, feature_cols: Sequence[str] = FEATURES) -> tuple[list[int], list[Sums], np.ndarray]:
    """(months, sums of each, the shift taken off every column): one row a month reaches the driver.

    Values are shifted by the columns' means first, so that the sums of products keep their digits."""
    rows = training_rows(features, feature_cols)
    cols = [*feature_cols, "label"]
    means = rows.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    shift = np.array([m or 0.0 for m in means])
    z = [F.col(c) - F.lit(float(s)) for c, s in zip(cols, shift, strict=True)]
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    found = rows.groupBy(MONTH_INDEX).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(f"a{i}") for i, x in enumerate(z)],
        *[F.sum(z[i] * z[j]).alias(f"b{i}_{j}") for i, j in pairs]).orderBy(MONTH_INDEX).collect()
    out = []
    for r in found:
        second = np.zeros((len(cols), len(cols)))
        for i, j in pairs:
            second[i, j] = second[j, i] = r[f"b{i}_{j}"]
        out.append(Sums(float(r["n"]), np.array([r[f"a{i}"] for i in range(len(cols))]), second))
    return [r[MONTH_INDEX] for r in found], out, shift


def solve(sums: Sums, alpha: float, l1_ratio: float, steps: int = 100_000, tolerance: float = 1e-12) -> np.ndarray:
    """Elastic-net weights (intercept last) by coordinate descent on the sums; same objective as ``train_demand_model``."""
    mean = sums.first / sums.n
    cov = sums.second / sums.n - np.outer(mean, mean)
    a, b = cov[:-1, :-1], cov[:-1, -1]
    w = np.zeros(len(b))
    for _ in range(steps):
        largest = 0.0
        for j in range(len(w)):
            rest = b[j] - a[j] @ w + a[j, j] * w[j]
            new = np.sign(rest) * max(abs(rest) - alpha * l1_ratio, 0.0) / (a[j, j] + alpha * (1 - l1_ratio)) if a[j, j] > 0 else 0.0
            largest = max(largest, abs(new - w[j]) * np.sqrt(max(a[j, j], 0.0)))
            w[j] = new
        if largest <= tolerance * np.sqrt(max(cov[-1, -1], 1e-300)):
            break
    return np.append(w, mean[-1] - mean[:-1] @ w)


def squared_error(sums: Sums, weights: np.ndarray) -> float:
    """Sum of squared residuals of the rows behind the sums."""
    v = np.append(-weights[:-1], 1.0)  # label - w x, the intercept apart
    c = weights[-1]
    return float(v @ sums.second @ v - 2 * c * (v @ sums.first) + c * c * sums.n)


def choose(spark: SparkSession, features: DataFrame, alphas: Sequence[float] = ALPHAS, l1_ratios: Sequence[float] = L1_RATIOS,
           n_folds: int = FOLDS, feature_cols: Sequence[str] = FEATURES) -> tuple[dict, DataFrame]:
    """(chosen parameters with their held-out error, table of every fold's error).

    The table has alpha, l1_ratio, fold, train_rows, validation_rows and rmse. The parameters with the least squared error over
    all validation rows are chosen; of equal ones the stronger penalty."""
    _, sums, _ = monthly_sums(features, feature_cols)
    bounds = fold_bounds(len(sums), n_folds)
    rows, best = [], None
    for alpha in alphas:
        for ratio in l1_ratios:
            total, n = 0.0, 0.0
            for k, (a, b) in enumerate(bounds, 1):
                train, held = _added(sums[:a]), _added(sums[a:b])
                error = max(squared_error(held, solve(train, alpha, ratio)), 0.0)
                rows.append((float(alpha), float(ratio), k, int(train.n), int(held.n), float(np.sqrt(error / held.n))))
                total, n = total + error, n + held.n
            key = (total / n, -alpha, -ratio)
            if best is None or key < best[0]:
                best = (key, {"alpha": float(alpha), "l1_ratio": float(ratio), "rmse": float(np.sqrt(total / n)), "folds": len(bounds)})
    return best[1], spark.createDataFrame(rows, "alpha double, l1_ratio double, fold int, train_rows long, validation_rows long, rmse double")


def _added(parts: Sequence[Sums]) -> Sums:
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out
