import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.plans import forecast as fc
from stratum.plans import model_choice as mc
from stratum.plans import model_registry as reg


def features(spark, months=24, per=40):
    rng = np.random.default_rng(3)
    rows = []
    for m in range(months):
        for k in range(per):
            x = rng.normal(1000, 200, 4)
            y = 3 + 0.6 * x[0] + 0.2 * x[1] + rng.normal(0, 20) + m
            rows.append((k, 1, f"{2020 + m // 12}{m % 12 + 1:02d}", 2020 * 12 + m, float(y), *map(float, x), m % 12 + 1))
    rows.append((99, 1, "202001", 2020 * 12, None, 1.0, None, 1.0, 1.0, 1))
    return spark.createDataFrame(rows, "store_id long, product_id long, year_month string, month_index int, label double, lag_1 double, "
                                       "lag_2 double, lag_3 double, rolling_mean_3 double, month_of_year int")


def test_folds_never_see_later_months(spark):
    df = features(spark)
    rows = mc.fold_months(df).collect()
    for k in (1, 2, 3):
        train = [r.year_month for r in rows if r.fold == k and r.role == "train"]
        held = [r.year_month for r in rows if r.fold == k and r.role == "validate"]
        assert max(train) < min(held) and len(held) == 6 and len(train) == 6 * k
    assert all(r.rows == 40 for r in rows)
    assert mc.fold_bounds(2) == [(1, 2)] and mc.fold_bounds(3) == [(1, 2), (2, 3)]
    with pytest.raises(ValueError):
        mc.fold_bounds(1)


def test_errors_equal_models_fitted_on_the_rows(spark):
    df = features(spark)
    chosen, table = mc.choose(spark, df, alphas=(0.5, 500.0), l1_ratios=(0.2,))
    known = fc.training_rows(df).toPandas()
    months = sorted(known.month_index.unique())
    for r in table.collect():
        a, b = mc.fold_bounds(24)[r.fold - 1]
        train, held = known[known.month_index < months[a]], known[known.month_index.isin(months[a:b])]
        model = fc.train_demand_model(df.where(F.col("month_index") < int(months[a])), r.alpha, r.l1_ratio)
        lr = model.stages[-1]
        pred = held[list(fc.FEATURES)].to_numpy() @ lr.coefficients.toArray() + lr.intercept
        assert r.rmse == pytest.approx(np.sqrt(np.mean((held.label - pred) ** 2)), rel=1e-4)
        assert (r.train_rows, r.validation_rows) == (len(train), len(held))
    by = {}
    for r in table.collect():
        by.setdefault(r.alpha, []).append(r.rmse ** 2 * r.validation_rows)
    best = min(by, key=lambda a: sum(by[a]))
    assert chosen["alpha"] == best and chosen["rmse"] == pytest.approx(np.sqrt(sum(by[best]) / 720), rel=1e-9)


def test_registry_keeps_versions_and_promotions(spark, scratch):
    df, root = features(spark), scratch("registry")
    with pytest.raises(ValueError):
        reg.predict_promoted(df, root, "m")
    for alpha in (0.5, 5.0):
        reg.register_model(fc.train_demand_model(df, alpha), root, "m", df, {"alpha": alpha, "l1_ratio": 0.2}, 1.5)
    assert reg.versions(spark, root, "m") == [1, 2] and not any(r.promoted for r in reg.model_table(spark, root, "m").collect())
    reg.promote_model(spark, root, "m", 2)
    reg.promote_model(spark, root, "m", 1)  # back again: the newest promotion holds
    with pytest.raises(ValueError):
        reg.promote_model(spark, root, "m", 3)
    table = {r.version: r for r in reg.model_table(spark, root, "m").collect()}
    assert table[1].promoted and not table[2].promoted and table[1].fingerprint == table[2].fingerprint
    assert table[1].training_rows == 960 and (table[1].first_month, table[1].last_month) == ("202001", "202112")
    out = reg.predict_promoted(df, root, "m")
    assert {r.model_version for r in out.collect()} == {1} and out.count() == 961
    other = reg.training_fingerprint(df.orderBy(F.rand(1)).repartition(3)).first()
    assert other.fingerprint == table[1].fingerprint
    changed = df.withColumn("lag_1", F.when(F.col("store_id") == 3, F.col("lag_1") + 0.01).otherwise(F.col("lag_1")))
    assert reg.training_fingerprint(changed).first().fingerprint != table[1].fingerprint
