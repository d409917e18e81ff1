"""Seasonal ARIMA: exact likelihood against the dense Gaussian density, choice of differences, recovery, held-out error."""

import numpy as np
import pytest

from tillcast.operators.forecast import sarima as S


def arma(rng, n, ar=(), ma=(), burn=200):
    e = rng.normal(0, 1, n + burn)
    y = np.zeros(n + burn)
    for t in range(n + burn):
        y[t] = e[t] + sum(a * y[t - k] for k, a in enumerate(ar, 1) if t >= k) + sum(b * e[t - k] for k, b in enumerate(ma, 1) if t >= k)
    return y[burn:]


@pytest.mark.parametrize("order", [(1, 0, 0, 0, True), (2, 1, 0, 0, False), (0, 2, 0, 1, True), (1, 1, 1, 1, True)])
def test_exact_likelihood(order):
    rng = np.random.default_rng(1)
    n, season = 60, 4
    w = rng.normal(1, 2, (3, n))
    theta = rng.normal(0, 0.4, (3, sum(order[:4]) + order[4]))
    v, logs = S.innovations(w, theta, order, season)
    ar, ma, mean = S.polynomials(theta, order, season)
    for i in range(3):
        psi = np.zeros(3000)  # the process as a long moving average
        for t in range(len(psi)):
            psi[t] = (ma[i, t] if t < ma.shape[1] else 0) - sum(ar[i, k] * psi[t - k] for k in range(1, min(t, ar.shape[1] - 1) + 1))
        gamma = np.array([(psi[:len(psi) - k] * psi[k:]).sum() for k in range(n)])
        cover = gamma[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))]
        x = w[i] - mean[i]
        assert np.isclose((v[i] ** 2 / np.exp(logs[i])).sum(), x @ np.linalg.solve(cover, x), rtol=1e-6)
        assert np.isclose(logs[i].sum(), np.linalg.slogdet(cover)[1], atol=1e-6)


def test_differences():
    rng = np.random.default_rng(2)
    walk = np.cumsum(rng.normal(0, 1, (6, 400)), 1)
    level = rng.normal(5, 1, (6, 400))
    weekly = level + 6 * np.sin(2 * np.pi * np.arange(400) / 7)
    d, D = S.differences(np.vstack([walk, level, weekly]), 7)
    assert (d[:6] == 1).sum() >= 5 and (d[6:12] == 0).sum() >= 5 and not D[:12].any() and D[12:].all()


def test_recovers_coefficients():
    rng = np.random.default_rng(3)
    y = 10 + np.stack([arma(rng, 1500, (0.7,), (0.4,)) for _ in range(6)])
    order = (1, 1, 0, 0, True)
    theta, _ = S.least_squares(S.conditional, y, S._start(y, order), order, 7, 10)
    theta, sse = S.least_squares(S._scaled, y, theta, order, 7, 5)
    ar, ma, mean = S.polynomials(theta, order, 7)
    assert np.allclose(-ar[:, 1], 0.7, atol=0.08) and np.allclose(ma[:, 1], 0.4, atol=0.08)
    assert np.allclose(mean, 10, atol=0.6) and np.allclose(sse / 1500, 1, atol=0.12)


def test_beats_autoregression_and_covers_short_series(spark):
    import datetime as dt

    from tillcast.operators.forecast import ar

    rng = np.random.default_rng(4)
    start, n, h = dt.date(2020, 1, 1), 240, 7
    series = {f"i{k}": np.cumsum(arma(rng, n + h, (), (0.6,))) + 8 * np.sin(2 * np.pi * np.arange(n + h) / 7) for k in range(8)}
    rows = [(i, start + dt.timedelta(days=t), float(v)) for i, s in series.items() for t, v in enumerate(s[:n])]
    rows += [("short", start + dt.timedelta(days=t), 3.0 + t % 2) for t in range(4)] + [("one", start, 2.0), ("flat", start, 5.0), ("none", start, None)]
    rows += [("flat", start + dt.timedelta(days=t), 5.0) for t in range(1, 100)]
    df = spark.createDataFrame(rows, "item_id string, date date, sales_amount double").repartition(3)
    got = S.fc_arima(df, h=h).toPandas()
    assert set(got["item_id"]) == {*series, "short", "one", "flat"} and len(got) == h * 11
    mean = got.groupby("item_id")["mean"].mean()
    assert np.isclose(mean["short"], 3.5) and np.isclose(mean["one"], 2) and np.isclose(mean["flat"], 5)
    base = ar.fc_ar(df.where("item_id not in ('one', 'none')"), h=h).toPandas()
    error = lambda f: np.mean([np.abs(f[f["item_id"] == i].sort_values("date")["mean"].to_numpy() - s[n:]).mean() for i, s in series.items()])
    assert error(got) < error(base)


def test_short_series_are_forecast_by_their_mean(spark):
    import datetime as dt

    from tillcast.operators.forecast import ar

    start = dt.date(2020, 1, 1)
    rng = np.random.default_rng(5)
    rows = [("long", start + dt.timedelta(days=t), float(v)) for t, v in enumerate(5 + arma(rng, 60, (0.5,)))]
    rows += [("short", start + dt.timedelta(days=t), 2.0 + t) for t in range(5)] + [("one", start, 4.0)]
    df = spark.createDataFrame(rows, "item_id string, date date, sales_amount double").repartition(2)
    for fc in (ar.fc_ar, ar.fc_arima):
        got = fc(df, h=3).toPandas()
        assert len(got) == 9
        mean = got.groupby("item_id")["mean"].mean()
        assert np.isclose(mean["short"], 4.0) and np.isclose(mean["one"], 4.0)
