"""Automatic seasonal ARIMA per series by exact likelihood.

A series is one row: its values in date order (bounded by the calendar). A
batch of series is worked on at once, as arrays over (series x parameters x
days); nothing loops over series.

1. Differences. One at the season where the weekly pattern explains most of
   the detrended variance (seasonal strength); then up to two at lag one while
   the KPSS statistic rejects a level.
2. Orders. Stepwise search from four starting models over p, q, P, Q and the
   constant by AICc, each order fitted by conditional least squares for all
   series that ask for it.
3. Fit. The chosen order by exact Gaussian likelihood: a Kalman filter that
   starts from the stationary state covariance and goes on as the innovations
   recursion once its variance has settled.
4. Forecast by the recursion of the full polynomial, future shocks zero.

Coefficients are searched as partial autocorrelations, so every fit is
stationary and invertible.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.session import ship_package

#: Largest p, q, P, Q; rounds of the stepwise search; steps of a conditional and of an exact fit; series of a batch.
MAX_ORDER, SEARCH_ROUNDS, STEPS, EXACT_STEPS, BATCH = (3, 3, 1, 1), 6, 8, 5, 64
# Seasonal strength from which a season is differenced; 5 % point of the KPSS level statistic.
STRENGTH, KPSS_5 = 0.64, 0.463

Order = tuple[int, int, int, int, bool]  # p, q, P, Q, constant


def seasonal_strength(y: np.ndarray, season: int) -> np.ndarray:
    """1 - var(remainder) / var(season + remainder), after a centred moving average; 0 for series of under two seasons."""
    n = y.shape[1]
    if n < 2 * season + 1:
        return np.zeros(len(y))
    half = season // 2
    cum = np.cumsum(np.pad(y, ((0, 0), (1, 0))), 1)
    loose = y[:, half:n - half] - (cum[:, season:] - cum[:, :-season])[:, :n - 2 * half] / season
    phase = np.arange(loose.shape[1]) % season
    means = np.stack([loose[:, phase == k].mean(1) for k in range(season)], 1)
    rest = loose - means[:, phase]
    total = loose.var(1)
    return np.where(total > 1e-12, np.maximum(0, 1 - rest.var(1) / np.where(total > 1e-12, total, 1)), 0.0)


def kpss(y: np.ndarray) -> np.ndarray:
    """The KPSS statistic of a constant level, with Bartlett weights up to 3 sqrt(n) / 13 lags."""
    n = y.shape[1]
    e = y - y.mean(1, keepdims=True)
    lags = int(3 * np.sqrt(n) / 13)
    s2 = (e * e).sum(1) / n
    for k in range(1, lags + 1):
        s2 = s2 + 2 * (1 - k / (lags + 1)) * (e[:, k:] * e[:, :-k]).sum(1) / n
    return np.where(s2 > 1e-12, (np.cumsum(e, 1) ** 2).sum(1) / (n * n * np.where(s2 > 1e-12, s2, 1)), 0.0)


def differences(y: np.ndarray, season: int) -> tuple[np.ndarray, np.ndarray]:
    """(d, D) of each series."""
    big = ((seasonal_strength(y, season) > STRENGTH) & (y.shape[1] > 3 * season)).astype(int)
    small = np.zeros(len(y), int)
    for s in (0, 1):
        at = np.flatnonzero(big == s)
        w = y[at][:, season:] - y[at][:, :-season] if s else y[at]
        for _ in range(2):
            if not len(at) or w.shape[1] < 10:
                break
            more = kpss(w) > KPSS_5
            at, w = at[more], np.diff(w[more], axis=1)
            small[at] += 1
    return small, big


def _from_partial(r: np.ndarray) -> np.ndarray:
    """Coefficients of a stationary autoregression from its partial autocorrelations (rows are models)."""
    phi = np.zeros_like(r)
    for k in range(r.shape[1]):
        head = phi[:, :k].copy()
        phi[:, :k] = head - r[:, k:k + 1] * head[:, ::-1]
        phi[:, k] = r[:, k]
    return phi


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of lag polynomials (rows), constant term first."""
    out = np.zeros((len(a), a.shape[1] + b.shape[1] - 1))
    for k in range(b.shape[1]):
        out[:, k:k + a.shape[1]] += b[:, k:k + 1] * a
    return out


def _spread(coef: np.ndarray, lag: int, sign: float) -> np.ndarray:
    """1 + sign (c1 L^lag + c2 L^2lag ...) as rows of coefficients."""
    out = np.zeros((len(coef), coef.shape[1] * lag + 1))
    out[:, 0] = 1
    for k in range(coef.shape[1]):
        out[:, (k + 1) * lag] = sign * coef[:, k]
    return out


def polynomials(theta: np.ndarray, order: Order, season: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(AR polynomial, MA polynomial, mean) of rows of free parameters."""
    p, q, P, Q, constant = order
    cut = np.cumsum([p, q, P, Q])
    r = np.tanh(theta[:, :cut[3]])
    ar = _times(_spread(_from_partial(r[:, :p]), 1, -1), _spread(_from_partial(r[:, cut[1]:cut[2]]), season, -1))
    ma = _times(_spread(_from_partial(r[:, p:cut[1]]), 1, 1), _spread(_from_partial(r[:, cut[2]:cut[3]]), season, 1))
    return ar, ma, theta[:, -1] if constant else np.zeros(len(theta))


def _recursion(u: np.ndarray, ma: np.ndarray, e: np.ndarray, start: int) -> np.ndarray:
    """Fill e from ``start``: e_t = u_t - sum b_j e_{t-j}; shocks before the first day are zero."""
    lags = np.flatnonzero(np.abs(ma[:, 1:]).max(0, initial=0) > 0) + 1
    if not len(lags):
        e[:, start:] = u[:, start:]
        return e
    m = int(lags.max())
    long = np.concatenate([np.zeros((len(e), m)), e], 1).T.copy()
    b = ma[:, lags].T.copy()
    for t in range(start, u.shape[1]):
        long[t + m] = u[:, t] - (b * long[t + m - lags]).sum(0)
    return long[m:].T


def _filtered(x: np.ndarray, ar: np.ndarray) -> np.ndarray:
    """The AR polynomial applied, days before the first as zero."""
    u = x * ar[:, :1]
    for k in range(1, ar.shape[1]):
        if np.any(ar[:, k]):
            u[:, k:] += ar[:, k:k + 1] * x[:, :-k]
    return u


def conditional(w: np.ndarray, theta: np.ndarray, order: Order, season: int) -> np.ndarray:
    """Residuals given the first days; those themselves count as zero."""
    ar, ma, mean = polynomials(theta, order, season)
    u = _filtered(w - mean[:, None], ar)
    u[:, :ar.shape[1] - 1] = 0
    return _recursion(u, ma, np.zeros_like(u), 0)


def innovations(w: np.ndarray, theta: np.ndarray, order: Order, season: int) -> tuple[np.ndarray, np.ndarray]:
    """Exact one-step errors and the logs of their variances over that of the shocks, by the Kalman filter."""
    ar, ma, mean = polynomials(theta, order, season)
    x = w - mean[:, None]
    rows, n = x.shape
    size = max(ar.shape[1] - 1, ma.shape[1], 1)
    move = np.zeros((rows, size, size))
    move[:, :ar.shape[1] - 1, 0] = -ar[:, 1:]
    move[:, np.arange(size - 1), np.arange(1, size)] = 1
    shock = np.zeros((rows, size))
    shock[:, :ma.shape[1]] = ma
    noise = shock[:, :, None] * shock[:, None, :]
    cover, power = noise.copy(), move.copy()
    for _ in range(40):  # the stationary covariance by doubling
        more = power @ cover @ power.transpose(0, 2, 1)
        cover, power = cover + more, power @ power
        if np.abs(more).max() < 1e-10 * np.abs(cover).max():
            break
    v, logs, state = np.zeros_like(x), np.zeros_like(x), np.zeros((rows, size))
    for t in range(n):
        f = np.maximum(cover[:, 0, 0], 1e-12)
        v[:, t], logs[:, t] = x[:, t] - state[:, 0], np.log(f)
        if t > size and np.abs(f - 1).max() < 1e-9:
            logs[:, t:] = 0  # settled: the innovations recursion gives the same errors
            return _recursion(_filtered(x, ar), ma, v, t + 1), logs
        gain = cover[:, :, 0] / f[:, None]
        state = np.einsum("bij,bj->bi", move, state + gain * v[:, t:t + 1])
        cover = move @ (cover - gain[:, :, None] * cover[:, :1, :]) @ move.transpose(0, 2, 1) + noise
    return v, logs


def _scaled(w, theta, order, season):
    """Errors whose sum of squares falls exactly when the exact likelihood rises."""
    v, logs = innovations(w, theta, order, season)
    return v * np.exp(-logs / 2 + logs.mean(1, keepdims=True) / 2)


def least_squares(residuals, w: np.ndarray, theta: np.ndarray, order: Order, season: int, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """(parameters, sum of squares) of all rows by damped Gauss-Newton steps."""
    rows, k = theta.shape
    r = residuals(w, theta, order, season)
    best = (r * r).sum(1)
    if not k:
        return theta, best
    damp = np.full(rows, 1e-2)
    scale = np.full(k, 1e-4)
    for _ in range(steps):
        width = np.where(np.arange(k) == k - 1, np.maximum(1e-4 * w.std(1), 1e-6)[:, None], scale) if order[4] else np.broadcast_to(scale, (rows, k))
        tried = np.repeat(theta[None], k, 0)
        tried[np.arange(k), :, np.arange(k)] += width.T
        moved = residuals(np.tile(w, (k, 1)), tried.reshape(k * rows, k), order, season).reshape(k, rows, -1)
        jac = ((moved - r[None]) / width.T[:, :, None]).transpose(1, 2, 0)
        normal, slope = jac.transpose(0, 2, 1) @ jac, np.einsum("btk,bt->bk", jac, r)
        diagonal = np.einsum("bkk->bk", normal)
        lifted = normal + (damp[:, None] * diagonal + 1e-9 * (1 + diagonal.max(1, keepdims=True)))[:, :, None] * np.eye(k)
        step = -np.linalg.solve(lifted, slope[:, :, None])[:, :, 0]
        free = k - order[4]
        step[:, :free] = np.clip(step[:, :free], -1, 1)
        new = theta + step
        new[:, :free] = np.clip(new[:, :free], -4, 4)
        s = residuals(w, new, order, season)
        with np.errstate(over="ignore", invalid="ignore"):  # a step too far is not taken
            sse = (s * s).sum(1)
        better = np.isfinite(sse) & (sse < best)
        gain = np.where(better, best - sse, 0).max() / max(best.max(), 1e-300)
        theta, r, best = np.where(better[:, None], new, theta), np.where(better[:, None], s, r), np.where(better, sse, best)
        damp = np.where(better, damp / 5, damp * 5)
        if gain < 1e-8 and better.any():
            break
    return theta, best


def _aicc(sse: np.ndarray, n: int, k: int) -> np.ndarray:
    """k counts the shock variance; a perfect fit is as good as can be."""
    if n - k - 1 <= 0:
        return np.full(len(sse), np.inf)
    return n * np.log(np.maximum(sse / n, 1e-12)) + 2 * k + 2 * k * (k + 1) / (n - k - 1)


def _start(w: np.ndarray, order: Order) -> np.ndarray:
    k = sum(order[:4]) + order[4]
    theta = np.full((len(w), k), 0.1)
    if order[4]:
        theta[:, -1] = w.mean(1)
    return theta


def _around(order: Order, most: tuple, constant: bool) -> list[Order]:
    p, q, P, Q, c = order
    near = [(p + a, q + b, P, Q, c) for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1), (1, 1), (-1, -1))]
    near += [(p, q, P + a, Q + b, c) for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1), (1, 1), (-1, -1))]
    near += [(p, q, P, Q, not c)] if constant else []
    return [o for o in near if all(0 <= x <= m for x, m in zip(o, most, strict=False))]


def search(w: np.ndarray, season: int, constant: bool, most: tuple, rounds: int = SEARCH_ROUNDS) -> list[Order]:
    """The order of least AICc that stepwise search reaches, for each series."""
    n = w.shape[1]
    if n <= 3 * season:
        most = (min(most[0], 1), min(most[1], 1), 0, 0)
    score: list[dict[Order, float]] = [{} for _ in w]
    start = {tuple(min(x, m) for x, m in zip(o, most, strict=True)) + (constant,) for o in ((2, 2, 1, 1), (0, 0, 0, 0), (1, 0, 1, 0), (0, 1, 0, 1))}
    asked = {o: list(range(len(w))) for o in sorted(start)}
    best: list = [None] * len(w)
    for _ in range(rounds):
        for order, rows in asked.items():
            lost = order[0] + order[2] * season
            _, sse = least_squares(conditional, w[rows], _start(w[rows], order), order, season, STEPS)
            value = _aicc(sse * n / max(1, n - lost), n, sum(order[:4]) + order[4] + 1) if n - lost > 3 else np.full(len(rows), np.inf)
            for i, v in zip(rows, value.tolist(), strict=True):
                score[i][order] = v
        asked = {}
        for i, tried in enumerate(score):
            now = min(tried, key=lambda o: (tried[o], sum(o[:4]), not o[4], o))
            if now != best[i]:
                best[i] = now
                for o in _around(now, most, constant):
                    if o not in tried:
                        asked.setdefault(o, []).append(i)
        if not asked:
            break
    return best


def fit_batch(y: np.ndarray, h: int, season: int, most: tuple = MAX_ORDER) -> tuple[np.ndarray, list[dict]]:
    """Forecasts (series, h) and the models (d, D, order, ar, ma, mean, sigma2) of series of one length."""
    out, models = np.zeros((len(y), h)), [{} for _ in y]
    small, big = differences(y, season)
    for d, D in sorted(set(zip(small.tolist(), big.tolist(), strict=True))):
        at = np.flatnonzero((small == d) & (big == D))
        w = y[at]
        if D:
            w = w[:, season:] - w[:, :-season]
        for _ in range(d):
            w = np.diff(w, axis=1)
        orders = search(w, season, d + D <= 1, most)
        for order in sorted(set(orders)):
            own = np.array([i for i, o in enumerate(orders) if o == order])
            theta, _ = least_squares(conditional, w[own], _start(w[own], order), order, season, STEPS)
            theta, sse = least_squares(_scaled, w[own], theta, order, season, EXACT_STEPS)
            ar, ma, mean = polynomials(theta, order, season)
            shocks, _ = innovations(w[own], theta, order, season)
            full = ar
            for _ in range(d):
                full = _times(full, np.tile([1.0, -1.0], (len(own), 1)))
            if D:
                full = _times(full, np.tile(np.eye(season + 1)[0] - np.eye(season + 1)[season], (len(own), 1)))
            out[at[own]] = _ahead(y[at[own]], shocks, full, ma, mean * ar.sum(1), h)
            for i, row in enumerate(at[own].tolist()):
                models[row] = {"d": d, "D": D, "order": order, "ar": ar[i], "ma": ma[i], "mean": mean[i], "sigma2": sse[i] / w.shape[1]}
    return out, models


def _ahead(y, shocks, ar, ma, constant, h):
    lags, back = ar.shape[1] - 1, ma.shape[1] - 1
    past = np.concatenate([np.zeros((len(y), max(0, lags - y.shape[1]))), y], 1)[:, -lags:] if lags else np.zeros((len(y), 0))
    e = np.concatenate([np.zeros((len(y), max(0, back - shocks.shape[1]))), shocks], 1)[:, -back:] if back else np.zeros((len(y), 0))
    out = np.zeros((len(y), h))
    for t in range(h):
        value = constant - (ar[:, 1:] * past[:, ::-1]).sum(1) + (ma[:, 1:] * e[:, ::-1]).sum(1)
        out[:, t] = value
        past = np.concatenate([past, value[:, None]], 1)[:, 1:] if lags else past
        e = np.concatenate([e, np.zeros((len(y), 1))], 1)[:, 1:] if back else e
    return out


def fc_arima(train: DataFrame, key: str = "item_id", date: str = "date", y: str = "sales_amount", season: int = 7, h: int = 28,
             name: str = "arima", most: tuple = MAX_ORDER) -> DataFrame:
    """key, date, model, mean: ``h`` days ahead of every series' last day.

    Days without a value are left out. Every series gets a forecast: one of a
    few days, or a constant one, that of its mean.
    """
    spark = train.sparkSession
    ship_package(spark)
    days = train.where(F.col(y).isNotNull()).groupBy(key).agg(F.max(date).alias("last"), F.sort_array(F.collect_list(F.struct(F.col(date), F.col(y).cast("double").alias("v")))).alias("s"))
    rows = days.select(key, "last", F.col("s.v").alias("v"))
    schema = T.StructType([rows.schema[key], T.StructField("date", T.DateType()), T.StructField("model", T.StringType()), T.StructField("mean", T.DoubleType())])

    def run(batches):
        for whole in batches:
            for k in range(0, len(whole), BATCH):
                pdf = whole.iloc[k:k + BATCH].reset_index(drop=True)
                for _, own in pdf.groupby(pdf["v"].map(len)):
                    values = np.stack(own["v"].to_numpy()).astype(float)
                    mean, _ = fit_batch(values, h, season, most)
                    yield pd.DataFrame({key: np.repeat(own[key].to_numpy(), h), "date": [last + pd.Timedelta(days=t) for last in own["last"] for t in range(1, h + 1)],
                                        "model": name, "mean": mean.ravel()})
    return rows.mapInPandas(run, schema)
