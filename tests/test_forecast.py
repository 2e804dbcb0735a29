import numpy as np
import pytest

from stratum.plans import forecast as fc


def test_lags_respect_missing_months(spark):
    rows = [("s", "p", "202401", 10.0), ("s", "p", "202402", 20.0), ("s", "p", "202404", 40.0),
            ("s", "p", "202501", 5.0)]
    df = spark.createDataFrame(rows, "store_id string, product_id string, year_month string, monthly_revenue double")
    got = {r.year_month: r for r in fc.demand_features(df).collect()}
    assert got["202402"].lag_1 == 10.0
    assert got["202404"].lag_1 is None and got["202404"].lag_2 == 20.0 and got["202404"].lag_3 == 10.0
    assert got["202404"].rolling_mean_3 == 15.0
    assert got["202501"].lag_1 is None and got["202501"].rolling_mean_3 is None  # crosses the year
    assert got["202501"].month_of_year == 1


def _enet_cd(X, y, alpha, l1_ratio, iters=5000):
    """Coordinate descent for 1/(2n)|y-Xw-b|^2 + a*r|w|_1 + a(1-r)/2|w|^2."""
    n, p = X.shape
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.zeros(p)
    for _ in range(iters):
        for j in range(p):
            r = yc - Xc @ w + Xc[:, j] * w[j]
            rho = Xc[:, j] @ r / n
            z = (Xc[:, j] ** 2).sum() / n + alpha * (1 - l1_ratio)
            w[j] = np.sign(rho) * max(abs(rho) - alpha * l1_ratio, 0) / z
    return w, y.mean() - X.mean(0) @ w


def test_elastic_net_matches_textbook_objective(spark):
    rng = np.random.default_rng(7)
    X = rng.normal(size=(400, 3)) * [1.0, 3.0, 0.5]
    y = X @ [2.0, -1.0, 0.3] + 4.0 + rng.normal(scale=0.5, size=400)
    rows = [(float(a), float(b), float(c), float(t)) for (a, b, c), t in zip(X, y)]
    df = spark.createDataFrame(rows, "lag_1 double, lag_2 double, lag_3 double, label double")
    model = fc.train_demand_model(df, 0.5, 0.2, feature_cols=("lag_1", "lag_2", "lag_3"), max_iter=500)
    lr = model.stages[-1]
    w, b = _enet_cd(X, y, 0.5, 0.2)
    assert np.allclose(lr.coefficients.toArray(), w, atol=2e-3)
    assert abs(lr.intercept - b) < 2e-3


def test_model_save_load_predict(spark, scratch):
    rng = np.random.default_rng(3)
    rows = [("s", "p", f"20{y}{m:02d}", float(rng.normal(50, 9))) for y in (21, 22, 23, 24) for m in range(1, 13)] + [("s", "q", "202405", 7.0)]
    df = spark.createDataFrame(rows, "store_id string, product_id string, year_month string, monthly_revenue double")
    feats = fc.demand_features(fc.with_next_month(df))
    path = scratch("model")
    model = fc.train_demand_model(feats)
    fc.save_model(model, path, "1")
    with pytest.raises(Exception):
        fc.save_model(model, path, "1")  # a version is never overwritten
    preds = {(r.product_id, r.year_month): r for r in fc.predict(fc.load_model(path, "1"), feats).collect()}
    assert len(preds) == 51  # every row, and the next month of both series
    assert preds[("p", "202501")].prediction is not None and preds[("p", "202501")].label is None
    assert preds[("p", "202102")].prediction is None and preds[("p", "202102")].reason == "lag_2 unknown"
    assert preds[("q", "202501")].prediction is None
    assert all(r.optimal for r in fc.optimality(model, feats).collect())
    with pytest.raises(RuntimeError):
        fc.train_demand_model(feats, max_iter=1)


def test_next_month_of_an_empty_table_and_over_the_year(spark):
    schema = "store_id string, product_id string, year_month string, monthly_revenue double"
    assert fc.with_next_month(spark.createDataFrame([], schema)).count() == 0
    got = fc.with_next_month(spark.createDataFrame([("s", "p", "202312", 1.0)], schema)).collect()
    assert {r.year_month for r in got} == {"202312", "202401"}


def test_huge_and_odd_amounts_do_not_stop_the_run(spark):
    from stratum.plans.forecast import demand_features

    rows = [(1, 1, "202401", 1e19), (1, 1, "202402", 2.5), (1, 1, "202403", float("nan")), (1, 1, "202404", 1.25),
            (2, 1, "202401", 0.1), (2, 1, "202402", 0.2), (2, 1, "202403", 0.3), (2, 1, "202404", None)]
    out = {(r.store_id, r.year_month): r for r in demand_features(
        spark.createDataFrame(rows, "store_id long, product_id long, year_month string, monthly_revenue double")).collect()}
    assert out[1, "202402"].rolling_mean_3 == 1e19 and out[1, "202402"].lag_1 == 1e19
    assert out[1, "202403"].rolling_mean_3 == (1e19 + 2.5) / 2
    assert str(out[1, "202404"].rolling_mean_3) == "nan" and str(out[1, "202404"].lag_1) == "nan"
    assert out[2, "202404"].rolling_mean_3 == 0.6 / 3 and out[2, "202403"].rolling_mean_3 == 0.3 / 2
