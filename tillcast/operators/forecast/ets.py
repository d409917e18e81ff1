"""Exponential smoothing with the form chosen per series.

State space forms: additive or multiplicative error (A, M), no, additive or
damped trend (N, A, D), no, additive or multiplicative season (N, A, M). All
have one recursion in error-correction shape: with q = level + phi trend, the
one-step forecast f = q + s (or q s) and the error e = y - f,

    level = q + alpha e / s,   trend = phi trend + beta e / s,   s = s + gamma e / q

(the divisors are 1 unless the season is multiplicative; a multiplicative error
changes the likelihood only). A batch is an array over (series x form): the
smoothing weights, the damping and the first level and trend of all of them
move together in damped Gauss-Newton steps of the form's likelihood, and the
form of least AICc is forecast. Multiplicative forms need values above zero.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.operators.forecast import series
from tillcast.operators.forecast.sarima import least_squares

# The forms (error, trend, season); a multiplicative season goes with a multiplicative error only.
FORMS = ["ANN", "AAN", "ADN", "ANA", "AAA", "ADA", "MNN", "MAN", "MDN", "MNA", "MAA", "MDA", "MNM", "MAM", "MDM"]
#: Bounds of the damping; optimiser steps; seasons the first season's shape is taken from.
PHI, STEPS, FIRST = (0.8, 0.98), 12, 4

#: Error, in units of the series, of a setting that runs away.
RULED_OUT = 1e3

NO_ORDER = (0, 0, 0, 0, False)  # all parameters are free ones


def _share(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-1.5 * x))


def first_season(y: np.ndarray, season: int, ratio: bool) -> np.ndarray:
    """Shape of the first seasons: mean deviation from (or ratio to) a centred moving average, summing to 0 (averaging 1)."""
    y = y[:, :FIRST * season + 2 * (season // 2)]
    half, n = season // 2, y.shape[1]
    cum = np.cumsum(np.pad(y, ((0, 0), (1, 0))), 1)
    level = (cum[:, season:] - cum[:, :-season])[:, :n - 2 * half] / season
    part = y[:, half:half + level.shape[1]]
    loose = part / np.maximum(level, 1e-9) if ratio else part - level
    phase = (np.arange(loose.shape[1]) + half) % season
    shape = np.stack([loose[:, phase == k].mean(1) for k in range(season)], 1)
    return np.maximum(shape / shape.mean(1, keepdims=True), 1e-3) if ratio else shape - shape.mean(1, keepdims=True)


class Stack:
    """Rows (series x form) of one length: what does not change while the parameters move."""

    def __init__(self, y: np.ndarray, forms: Sequence[str], season: int):
        error, trend, shape = (np.array([f[i] for f in forms]) for i in range(3))
        self.season, self.relative, self.times = season, error == "M", shape == "M"
        self.trended, self.damped, self.seasonal = trend != "N", trend == "D", shape != "N"
        self.s0 = np.where(self.times, 1.0, 0.0)[:, None] * np.ones(season)
        for ratio in (False, True):
            at = np.flatnonzero(self.seasonal & (self.times == ratio))
            if len(at):
                self.s0[at] = first_season(y[at], season, ratio)
        m = min(season, y.shape[1] // 2)
        a, b = y[:, :m].mean(1), y[:, m:2 * m].mean(1)
        self.slope = np.where(self.trended, (b - a) / m, 0.0)
        self.level = a - self.slope * (m + 1) / 2
        self.unit = np.maximum(y.std(1), 1e-6)

    def parameters(self, theta: np.ndarray, times: int):
        """alpha, beta, gamma, phi, first level, first trend of ``times`` blocks of all rows."""
        t = lambda x: np.tile(x, times)
        alpha = _share(theta[:, 0])
        beta = np.where(t(self.trended), alpha * _share(theta[:, 1]), 0.0)
        gamma = np.where(t(self.seasonal), (1 - alpha) * _share(theta[:, 2]), 0.0)
        phi = np.where(t(self.damped), PHI[0] + (PHI[1] - PHI[0]) * _share(theta[:, 3]), 1.0)
        level = t(self.level) + t(self.unit) * theta[:, 4]
        trend = np.where(t(self.trended), t(self.slope) + t(self.unit / self.season) * theta[:, 5], 0.0)
        return alpha, beta, gamma, phi, level, trend

    def errors(self, y: np.ndarray, theta: np.ndarray):
        """One-step forecasts and errors, and the last states (level, trend, season by day modulo the season)."""
        times = len(y) // len(self.level)
        alpha, beta, gamma, phi, level, trend = self.parameters(theta, times)
        s = np.tile(self.s0, (times, 1)).T.copy()
        product = np.tile(self.times, times)
        mixed = bool(product.any())
        days = np.ascontiguousarray(y.T)
        fit, err = np.empty_like(days), np.empty_like(days)
        with np.errstate(all="ignore"):  # a setting that runs away is not taken
            for t in range(len(days)):
                phase = t % self.season
                now = s[phase]
                q = level + phi * trend
                f = np.where(product, q * now, q + now) if mixed else q + now
                e = days[t] - f
                fit[t], err[t] = f, e
                by_level = e / np.where(product, now, 1.0) if mixed else e
                s[phase] = now + gamma * (e / np.where(product, q, 1.0) if mixed else e)
                level = q + alpha * by_level
                trend = phi * trend + beta * by_level
        return fit.T, err.T, (level, trend, s.T, phi)

    def residuals(self, y: np.ndarray, theta: np.ndarray, order=None, season=None) -> np.ndarray:
        """Errors, in units of the series, whose sum of squares falls exactly when the form's likelihood rises;
        a forecast not above zero rules a multiplicative error out."""
        fit, err, _ = self.errors(y, theta)
        times = len(y) // len(self.level)
        relative = np.tile(self.relative, times)[:, None]
        with np.errstate(all="ignore"):
            if relative.any():
                scaled = err / fit * np.exp(np.log(fit).mean(1, keepdims=True))
                err = np.where(relative, np.where((fit > 0).all(1, keepdims=True), scaled, np.nan), err)
            err = err / np.tile(self.unit, times)[:, None]
            return np.where(np.isfinite(err).all(1, keepdims=True) & (np.abs(err) < RULED_OUT).all(1, keepdims=True), err, RULED_OUT)


def size(form: str, season: int) -> int:
    """Parameters of a form: weights, damping, first states, shock variance."""
    return 3 + 2 * (form[1] != "N") + (form[1] == "D") + season * (form[2] != "N")


def fit_batch(y: np.ndarray, h: int, season: int, forms: Sequence[str] = FORMS, steps: int = STEPS) -> tuple[np.ndarray, list[str | None]]:
    """Forecasts (series, h) and the chosen form of series of one length; the mean, and no form, where none has room."""
    count, n = y.shape
    positive = (y > 0).all(1)
    # a season is judged on two whole ones at least
    open_ = [f for f in forms if n - size(f, season) - 1 > 0 and (f[2] == "N" or n >= 3 * season)]
    pairs = [(i, f) for f in open_ for i in range(count) if f[0] == "A" or positive[i]]
    out, chosen = np.repeat(y.mean(1, keepdims=True), h, 1), [None] * count
    if not pairs:
        return out, chosen
    own, form = np.array([p[0] for p in pairs]), [p[1] for p in pairs]
    rows = y[own]
    stack = Stack(rows, form, season)
    start = np.tile(np.array([-0.8, -1.5, -1.5, 0.8, 0.0, 0.0]), (len(rows), 1))
    theta, sse = least_squares(stack.residuals, rows, start, NO_ORDER, season, steps)
    k = np.array([size(f, season) for f in form])
    with np.errstate(all="ignore"):
        score = n * np.log(np.maximum(sse * stack.unit ** 2 / n, 1e-12)) + 2 * k + 2 * k * (k + 1) / (n - k - 1)
    score = np.where(np.isfinite(score) & (sse < RULED_OUT ** 2), score, np.inf)
    _, _, (level, trend, s, phi) = stack.errors(rows, theta)
    best: dict[int, int] = {}
    for j, i in enumerate(own.tolist()):
        if np.isfinite(score[j]) and (i not in best or score[j] < score[best[i]]):
            best[i] = j
    at = np.array([best[i] for i in sorted(best)], int)
    ahead = np.arange(1, h + 1)
    damped = np.cumsum(phi[at][:, None] ** ahead, 1)
    q = level[at][:, None] + damped * trend[at][:, None]
    s = s[at][:, (n + ahead - 1) % season]
    out[sorted(best)] = np.where(stack.times[at][:, None], q * s, q + s)
    for i, j in best.items():
        chosen[i] = form[j]
    return out, chosen


def fc_ets(train: DataFrame, key: str = "item_id", date: str = "date", y: str = "sales_amount", season: int = 7, h: int = 28,
           name: str = "ets", forms: Sequence[str] = FORMS) -> DataFrame:
    """key, date, model, mean, form: ``h`` days ahead of every series' last day.

    Days without a value are left out. Every series with a value gets a
    forecast: one too short for any form that of its mean, with a null form.
    """
    rows = train.where(F.col(y).isNotNull()).select(key, date, F.col(y).cast("double").alias("_y"))

    def model(some: list[pd.DataFrame]):
        lengths = np.array([len(p) for p in some])
        for n in np.unique(lengths):
            own = [some[i] for i in np.flatnonzero(lengths == n)]
            mean, chosen = fit_batch(np.stack([p["_y"].to_numpy(float) for p in own]), h, season, forms)
            for p, m, f in zip(own, mean, chosen, strict=True):
                yield p[key].iloc[0], series.days_after(p[date].iloc[-1], h), m, (f,)

    return series.forecast_by_batch(rows, key, date, name, model, [T.StructField("form", T.StringType())])
