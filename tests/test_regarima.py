"""Regression with chosen ARIMA errors: recovery, generalised least squares against the dense one, differences, edge series."""

import datetime as dt

import numpy as np
import pytest

from tests.test_sarima import arma
from tillcast.operators.forecast import regarima as R
from tillcast.operators.forecast import sarima as S


def test_coefficients_and_errors_recover():
    rng = np.random.default_rng(1)
    n = 900
    x = rng.normal(0, 1, (6, n, 2))
    y = 4 + 2 * x[:, :, 0] - 3 * x[:, :, 1] + np.stack([arma(rng, n, (0.7,), (0.4,)) for _ in range(6)])
    both = np.concatenate([x, np.ones((6, n, 1))], 2)
    beta, theta = R.estimate(y, both, (1, 1, 0, 0, False), 7)
    ar, ma, _ = S.polynomials(theta, (1, 1, 0, 0, False), 7)
    assert np.allclose(beta[:, :2], [2, -3], atol=0.1) and np.allclose(beta[:, 2], 4, atol=0.7)
    assert np.allclose(-ar[:, 1], 0.7, atol=0.1) and np.allclose(ma[:, 1], 0.4, atol=0.1)


@pytest.mark.parametrize("order", [(1, 0, 0, 0, False), (0, 2, 0, 0, False), (1, 0, 0, 1, False)])
def test_filtered_gram_equals_dense_generalised_least_squares(order):
    rng = np.random.default_rng(2)
    n, season = 50, 4
    x, y = rng.normal(0, 1, (2, n, 3)), rng.normal(0, 1, (2, n))
    theta = rng.normal(0, 0.4, (2, sum(order[:4])))
    seen = R._filtered(np.concatenate([x, y[:, :, None]], 2), theta, order, season)
    beta = R._solve(seen[:, :, :-1], seen[:, :, -1])
    ar, ma, _ = S.polynomials(theta, order, season)
    for i in range(2):
        psi = np.zeros(2000)
        for t in range(len(psi)):
            psi[t] = (ma[i, t] if t < ma.shape[1] else 0) - sum(ar[i, k] * psi[t - k] for k in range(1, min(t, ar.shape[1] - 1) + 1))
        gamma = np.array([(psi[:len(psi) - k] * psi[k:]).sum() for k in range(n)])
        inverse = np.linalg.inv(gamma[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))])
        assert np.allclose(beta[i], np.linalg.solve(x[i].T @ inverse @ x[i], x[i].T @ inverse @ y[i]), atol=1e-5)


def test_chosen_errors():
    rng = np.random.default_rng(3)
    n, h = 400, 7
    x = (rng.random((8, n + h, 1)) < 0.3).astype(float)
    walk = np.cumsum(rng.normal(0, 1, (4, n + h)), 1)
    auto = np.stack([arma(rng, n + h, (0.8,)) for _ in range(4)])
    y = 5 * x[:, :, 0] + np.vstack([walk, auto])
    mean, models = R.fit_batch(y[:, :n], x[:, :n], x[:, n:], 7)
    assert all(m["d"] == 1 for m in models[:4]) and sum(m["d"] == 0 and m["order"][0] >= 1 for m in models[4:]) >= 3
    assert np.allclose([m["beta"][0] for m in models], 5, atol=0.5)
    flat = np.repeat(y[:, :n].mean(1, keepdims=True), h, 1)
    assert np.abs(mean - y[:, n:]).mean() < 0.7 * np.abs(flat - y[:, n:]).mean()


def test_constant_and_collinear_regressors():
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (3, 200, 1))
    whole = np.concatenate([x, 2 * x, np.full((3, 200, 1), 7.0), np.zeros((3, 200, 1))], 2)
    y = 1 + 3 * x[:, :, 0] + np.stack([arma(rng, 200, (0.5,)) for _ in range(3)])
    y[2] = 4.0
    mean, _ = R.fit_batch(y, whole, whole[:, :5], 7)
    assert np.isfinite(mean).all() and np.allclose(mean[2], 4, atol=1e-3)


def test_every_series_with_a_day_gets_its_future(spark):
    rng = np.random.default_rng(5)
    start = dt.date(2020, 1, 1)
    day = lambda t: start + dt.timedelta(days=t)
    rows = [(i, day(t), float(2 + 4 * (t % 5 == 0) + e), t % 5 == 0) for i in ("a", "b") for t, e in enumerate(rng.normal(0, 0.1, 150))]
    rows += [("short", day(t), 2.0 + t, False) for t in range(3)] + [("null", day(0), None, False), (None, day(0), 1.0, False)]
    rows += [("a2", day(t), None if t % 2 else 3.0, None) for t in range(60)]
    train = spark.createDataFrame([(i, d, v, None if p is None else int(p)) for i, d, v, p in rows], "item_id string, date date, y double, p int").repartition(3)
    future = spark.createDataFrame([(i, day(200 + t), int(t % 5 == 0)) for i in ("a", "b", "short", "null", "a2", "new") for t in range(5)], "item_id string, date date, p int")
    got = R.fc_regarima(train, future, ["p"], "m").toPandas()
    assert sorted(set(got["item_id"])) == ["a", "a2", "b", "short"] and len(got) == 20
    at = got.set_index(["item_id", "date"])["mean"]
    assert np.isclose(at["a"][day(200)] - at["a"][day(201)], 4, atol=0.3) and np.isclose(at["short"][day(200)], 3)
    assert np.allclose(at["a2"], 3, atol=1e-3)
    assert R.fc_regarima(train.where("false"), future, ["p"], "m").count() == 0
