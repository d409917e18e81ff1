"""Regression with ARIMA errors, orders chosen per series.

y = b'x + error, the error a seasonal ARIMA. Per batch of series, as arrays:

1. Least squares; the differences are chosen on its residuals and then taken of
   y and of every regressor.
2. Orders of the error by stepwise search on the differenced residuals.
3. Generalised least squares: the exact one-step filter of the error model goes
   over y and every regressor, a Gram sum of the filtered columns gives the next
   coefficients, their residuals the next error model, until the coefficients
   stand still. An AR(1) error is one case.
4. Forecast: the error's recursion plus b'x of the days ahead.

The filter is linear, so no likelihood over the coefficients is searched.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.operators.forecast import gram, sarima, series

#: Rounds of generalised least squares; steps of the error model from the second on; change of the fit, over the largest value, at which
#: the coefficients stand still; ridge.
ROUNDS, AGAIN, STILL, RIDGE = 6, 2, 1e-4, 1e-9


def _solve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Least squares (series, columns) of y (series, days) on x (series, days, columns); columns of zeros get 0."""
    width = np.sqrt((x * x).sum(1))
    unit = np.where(width > 1e-9, width, 1.0)
    x = np.where(width[:, None] > 1e-9, x / unit[:, None], 0.0)
    return gram.solve_batch(x.transpose(0, 2, 1) @ x, np.einsum("bnk,bn->bk", x, y), RIDGE) / unit


def _differenced(a: np.ndarray, d: int, D: int, season: int) -> np.ndarray:
    """Along axis 1."""
    if D:
        a = a[:, season:] - a[:, :-season]
    return np.diff(a, n=d, axis=1) if d else a


def _filtered(a: np.ndarray, theta: np.ndarray, order: sarima.Order, season: int) -> np.ndarray:
    """Exact one-step errors of the columns of a (series, days, columns), scaled as the likelihood weighs them."""
    rows, n, k = a.shape
    v, logs = sarima.innovations(a.transpose(0, 2, 1).reshape(rows * k, n), np.repeat(theta, k, 0), order, season)
    return (v * np.exp(-logs / 2)).reshape(rows, k, n).transpose(0, 2, 1)


def estimate(y: np.ndarray, x: np.ndarray, order: sarima.Order, season: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(coefficients, error parameters) of series of one error order, already differenced."""
    beta = _solve(x, y)
    theta = sarima._start(y, order)
    before = np.full(y.shape, np.inf)
    both = np.concatenate([x, y[:, :, None]], 2)
    for turn in range(rounds):
        mean = np.einsum("bnk,bk->bn", x, beta)
        if np.abs(mean - before).max() <= STILL * max(np.abs(y).max(), 1e-12):
            break
        before = mean
        if not turn:
            theta, _ = sarima.least_squares(sarima.conditional, y - mean, theta, order, season, sarima.STEPS)
        theta, _ = sarima.least_squares(sarima._scaled, y - mean, theta, order, season, AGAIN if turn else sarima.EXACT_STEPS)
        if not sum(order[:4]):
            break
        seen = _filtered(both, theta, order, season)
        beta = _solve(seen[:, :, :-1], seen[:, :, -1])
    return beta, theta


def fit_batch(y: np.ndarray, x: np.ndarray, ahead: np.ndarray, season: int, most: tuple = sarima.MAX_ORDER) -> tuple[np.ndarray, list[dict]]:
    """Forecasts (series, h) and models of series of one length: y (series, days), x (series, days, columns), ahead (series, h, columns).

    A constant (the drift, once a difference is taken) is the last column unless two differences are.
    Series of fewer than three days a coefficient are forecast by their mean, with an empty model.
    """
    count, n, k = x.shape
    h = ahead.shape[1]
    out, models = np.repeat(y.mean(1, keepdims=True), h, 1), [{} for _ in y]
    if n < 3 * (k + 2):
        return out, models
    one = np.ones((count, n, 1))
    full = np.concatenate([x, one], 2)
    loose = y - np.einsum("bnk,bk->bn", full, _solve(full, y))
    small, big = sarima.differences(loose, season)
    for d, D in sorted(set(zip(small.tolist(), big.tolist(), strict=True))):
        at = np.flatnonzero((small == d) & (big == D))
        drift = d + D <= 1
        wy, wx = _differenced(y[at], d, D, season), _differenced(x[at], d, D, season)
        if drift:
            wx = np.concatenate([wx, np.ones((*wy.shape, 1))], 2)
        rest = wy - np.einsum("bnk,bk->bn", wx, _solve(wx, wy))
        orders = sarima.search(rest, season, False, most)
        for order in sorted(set(orders)):
            own = np.array([i for i, o in enumerate(orders) if o == order])
            beta, theta = estimate(wy[own], wx[own], order, season)
            slope, level = beta[:, :k], beta[:, k] if drift else np.zeros(len(own))
            shocks, _ = sarima.innovations(wy[own] - np.einsum("bnk,bk->bn", wx[own], beta), theta, order, season)
            ar, ma, _ = sarima.polynomials(theta, order, season)
            whole = ar
            for _ in range(d):
                whole = sarima._times(whole, np.tile([1.0, -1.0], (len(own), 1)))
            if D:
                whole = sarima._times(whole, np.tile(np.eye(season + 1)[0] - np.eye(season + 1)[season], (len(own), 1)))
            error = y[at[own]] - np.einsum("bnk,bk->bn", x[at[own]], slope)
            out[at[own]] = sarima._ahead(error, shocks, whole, ma, level * ar.sum(1), h) + np.einsum("bhk,bk->bh", ahead[at[own]], slope)
            for i, row in enumerate(at[own].tolist()):
                models[row] = {"d": d, "D": D, "order": order, "beta": slope[i], "constant": level[i], "ar": ar[i], "ma": ma[i]}
    return out, models


def fc_regarima(train: DataFrame, future: DataFrame, xcols: Sequence[str], name: str, key: str = "item_id", date: str = "date",
                y: str = "y", season: int = 7, most: tuple = sarima.MAX_ORDER) -> DataFrame:
    """key, date, model, mean for every row of ``future`` whose series has a day in ``train``.

    ``train`` has key, date, ``y`` and ``xcols``, ``future`` the days ahead with the same regressors. Days
    without a value are left out; a missing regressor counts as 0. Both go through one shuffle by
    series, so neither is joined to the other. A series too short for its coefficients is forecast by its mean.
    """
    def rows(df, value, ahead):
        return df.select(key, date, value.cast("double").alias("_y"), F.lit(ahead).alias("_ahead"),
                         *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_x{i}") for i, c in enumerate(xcols)])

    both = rows(train.where(F.col(y).isNotNull()), F.col(y), False).unionByName(rows(future, F.lit(None), True))
    names = [f"_x{i}" for i in range(len(xcols))]

    def model(some: list[pd.DataFrame]):
        parts = [(p[~p["_ahead"]], p[p["_ahead"]]) for p in some]
        sizes = [(len(a), len(b)) for a, b in parts]
        for n, h in sorted(set(sizes)):
            if n and h:
                own = [parts[i] for i, s in enumerate(sizes) if s == (n, h)]
                mean, _ = fit_batch(np.stack([a["_y"].to_numpy(float) for a, _ in own]), np.stack([a[names].to_numpy(float) for a, _ in own]),
                                    np.stack([b[names].to_numpy(float) for _, b in own]), season, most)
                for (_, b), m in zip(own, mean, strict=True):
                    yield b[key].iloc[0], b[date].to_list(), m, ()

    return series.forecast_by_batch(both, key, date, name, model)
