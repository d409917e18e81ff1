"""Sparse changepoints: optimality conditions, a reference solver, recovery of a kink, flat and short data."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from tillcast.operators.forecast import decomposable as D


def proximal(g, c, penalty, steps=200_000):
    """Proximal gradient with momentum, one row at a time."""
    rate, out = 1 / np.linalg.eigvalsh(g).max(), []
    for row, p in zip(c, penalty, strict=True):
        b = z = np.zeros(len(g))
        t = 1.0
        for _ in range(steps):
            step = z - rate * (g @ z - row)
            new = np.sign(step) * np.maximum(np.abs(step) - rate * p, 0)
            t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
            z, t = new + (t - 1) / t2 * (new - b), t2
            if np.abs(new - b).max() < 1e-13:
                b = new
                break
            b = new
        out.append(b)
    return np.stack(out)


def test_lasso_equals_reference_and_is_optimal():
    rng = np.random.default_rng(1)
    x = np.maximum(np.arange(300)[:, None] / 300 - np.arange(8) / 9, 0)
    g, c = x.T @ x, rng.normal(0, 5, (5, 300)) @ x
    penalty = np.array([0.1, 0.5, 1, 3, 100.0])
    b = D.lasso(g, c, penalty)
    value = lambda b: 0.5 * np.einsum("bi,ij,bj->b", b, g, b) - (b * c).sum(1) + penalty * np.abs(b).sum(1)
    assert np.allclose(value(b), value(proximal(g, c, penalty)), rtol=1e-6, atol=1e-8) and not b[4].any()
    slope = c - b @ g
    for i in range(5):
        on = b[i] != 0
        assert np.allclose(slope[i][on], penalty[i] * np.sign(b[i][on]), atol=1e-4 * penalty[i])
        assert (np.abs(slope[i][~on]) <= penalty[i] * (1 + 1e-6)).all()


def test_kink_is_found_and_the_rest_stays_unused():
    rng = np.random.default_rng(2)
    n, years = 1500, 1500 / 365.25
    t = np.arange(n) / 365.25
    places = years * 0.8 * np.arange(1, 26) / 26
    hinges = np.maximum(t[:, None] - places, 0)
    x = np.concatenate([np.ones((n, 1)), t[:, None], hinges, np.sin(2 * np.pi * t)[:, None]], 1)
    y = np.stack([10 + 3 * t + a * hinges[:, 12] + 2 * np.sin(2 * np.pi * t) + rng.normal(0, 0.3, n) for a in (0, 8, -8)])
    beta = D.sparse_fit(x.T @ x, y @ x, (y * y).sum(1), np.full(3, n), np.abs(y).max(1), years, slice(2, 27))
    change = beta[:, 2:27]
    plain = np.linalg.lstsq(x, y[0], rcond=None)[0][2:27]
    assert np.abs(change[0]).sum() < 0.1 * np.abs(plain).sum() and (change[0] == 0).sum() >= 15
    for i, a in ((1, 8), (2, -8)):
        assert np.isclose(change[i].sum(), a, atol=1) and np.abs(change[i, 10:15]).sum() > 0.85 * np.abs(change[i]).sum()
        assert (np.abs(change[i]) < 1e-9).sum() >= 12
    assert np.allclose((x @ beta.T).T, y, atol=2)


def test_forecast_of_small_tables(spark):
    start = dt.date(2020, 1, 1)
    cal = spark.createDataFrame([(start + dt.timedelta(days=t), "Fair" if t % 90 == 3 else None, None) for t in range(428)],
                                "date date, event_name_1 string, event_name_2 string")
    rows = [(i, start + dt.timedelta(days=t), v(t)) for i, v in (("flat", lambda t: 5.0), ("zero", lambda t: 0.0), ("up", lambda t: 1 + t / 100))
            for t in range(400)]
    train = spark.createDataFrame(rows, "item_id string, date date, sales_amount double").repartition(3)
    end = start + dt.timedelta(days=399)
    got = D.fc_decomposable(train, cal, F.lit(start), F.lit(end)).toPandas()
    mean = got.groupby("item_id")["mean"].agg(["mean", "count"])
    assert (mean["count"] == 28).all() and abs(mean["mean"]["zero"]) < 1e-6
    assert abs(mean["mean"]["flat"] - 5) < 0.1 and abs(mean["mean"]["up"] - 5.13) < 0.3
    assert D.fc_decomposable(train.where("false"), cal, F.lit(start), F.lit(end)).count() == 0
