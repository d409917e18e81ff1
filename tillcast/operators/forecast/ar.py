"""Automatic autoregression per series.

Lags come from a window per series; one Gram aggregation over
[1, y_{t-1} .. y_{t-P}, y_{t-S}] serves every candidate order, because
conditional least squares on a common sample makes each candidate a
sub-block of the same sums. Each series picks its order (p in 0..P, with or
without the seasonal lag S) by AICc, then forecasts recursively from its
last S values. A series too short for a complete lag row is forecast by its mean.

``fc_arima`` adds moving-average terms by the Hannan-Rissanen two-stage
method, still as aggregations: a long autoregression per series (one Gram
aggregation and a batched solve) gives residuals as a JVM expression; a
second Gram aggregation over [1, y lags, seasonal lag, residual lags]
serves every (p, seasonal, q) candidate, chosen by AICc; the forecast
recursion sets future shocks to zero.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.operators.forecast import gram


def candidates(p_max: int) -> list[tuple[int, bool]]:
    return list(itertools.product(range(p_max + 1), (False, True)))


def choose(xtx: np.ndarray, xty: np.ndarray, yty: np.ndarray, n: np.ndarray, candidates: list[list[int]]) -> np.ndarray:
    """Coefficients (series, k) of the candidate columns of least AICc, zero elsewhere; each candidate is solved for all series at once."""
    best, coefs = np.full(len(xtx), np.nan), np.zeros(xty.shape)
    for idx in candidates:
        a, c = xtx[:, idx][:, :, idx], xty[:, idx]
        beta = np.einsum("bij,bj->bi", np.linalg.pinv(a, rcond=1e-10, hermitian=True), c)
        sse = np.maximum(yty - 2 * np.einsum("bi,bi->b", beta, c) + np.einsum("bi,bij,bj->b", beta, a, beta), 0.0)
        k = len(idx) + 1
        room = n - k - 1
        score = np.where(sse > 0, n * np.log(np.where(sse > 0, sse, 1) / np.maximum(n, 1)) + 2 * k + 2 * k * (k + 1) / np.where(room > 0, room, 1), -np.inf)
        score = np.where(room > 0, score, np.where(sse > 0, np.inf, -np.inf))
        better = np.isnan(best) | (score < best)
        best[better] = score[better]
        coefs[better] = 0
        coefs[np.ix_(better, idx)] = beta[better]
    return coefs


def _blocks(pdf: pd.DataFrame, k: int) -> tuple[np.ndarray, ...]:
    """Gram blocks of a batch; series without a complete lag row have zeros, so that only their mean is left to forecast."""
    none = pdf["n"].isna().to_numpy()
    fill = lambda name, size: np.stack([np.zeros(size) if x is None or np.ndim(x) == 0 else np.asarray(x, float) for x in pdf[name]])
    return gram.unpack(fill("xtx", k * (k + 1) // 2), k), fill("xty", k), pdf["yty"].fillna(0).to_numpy(float), pdf["n"].fillna(0).to_numpy(float), none


def _histories(tails, size: int, field: str) -> np.ndarray:
    """The last ``size`` values of each series, oldest first, zeros before the first."""
    out = np.zeros((len(tails), size))
    for b, tail in enumerate(tails):
        values = [r[field] if r[field] is not None else 0.0 for r in tail]
        out[b, size - len(values):] = values
    return out


def _rows(pdf: pd.DataFrame, key: str, name: str, mean: np.ndarray) -> pd.DataFrame:
    h = mean.shape[1]
    return pd.DataFrame({key: np.repeat(pdf[key].to_numpy(), h), "date": [last + pd.Timedelta(days=t) for last in pdf["last_date"] for t in range(1, h + 1)],
                         "model": name, "mean": mean.ravel()})


def lagged(train: DataFrame, key: str, date: str, y: str, p_max: int, season: int) -> DataFrame:
    w = Window.partitionBy(key).orderBy(date)
    lags = [F.lag(y, i).over(w).alias(f"_l{i}") for i in range(1, p_max + 1)]
    return train.select(key, date, F.col(y).cast("double").alias("y"), *lags,
                        F.lag(y, season).over(w).alias("_ls"))


def fc_ar(train: DataFrame, key: str = "item_id", date: str = "date", y: str = "sales_amount",
          p_max: int = 3, season: int = 7, h: int = 28, name: str = "ar") -> DataFrame:
    lx = [f"_l{i}" for i in range(1, p_max + 1)] + ["_ls"]
    lg = lagged(train, key, date, y, p_max, season)
    sums = gram.gram_sums(lg.filter(F.col("_ls").isNotNull()), key, lx, "y")
    # last `season` observations per series, oldest first (bounded per series)
    wd = Window.partitionBy(key).orderBy(F.col(date).desc())
    tail = (train.select(key, date, F.col(y).cast("double").alias("v"), F.row_number().over(wd).alias("rn"))
            .filter(F.col("rn") <= season)
            .groupBy(key).agg(F.max(date).alias("last_date"),
                              F.sort_array(F.collect_list(F.struct(date, "v"))).alias("tail")))
    model_in = tail.join(sums, key, "left")
    k_full = len(lx) + 1
    cands = [[0, *range(1, p + 1), *([k_full - 1] if seas else [])] for p, seas in candidates(p_max)]
    schema = T.StructType([model_in.schema[key], T.StructField("date", T.DateType()),
                           T.StructField("model", T.StringType()), T.StructField("mean", T.DoubleType())])

    def run(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            xtx, xty, yty, n, none = _blocks(pdf, k_full)
            coefs = choose(xtx, xty, yty, n, cands)
            coefs[none, 0] = [np.mean([r["v"] for r in t]) for t in pdf["tail"][none]]  # all of a short series is in its tail
            hist = _histories(pdf["tail"], max(season, p_max), "v")
            mean = np.zeros((len(pdf), h))
            for step in range(h):
                x = np.concatenate([np.ones((len(pdf), 1)), hist[:, ::-1][:, :p_max], hist[:, -season][:, None]], 1)
                mean[:, step] = (coefs * x).sum(1)
                hist = np.concatenate([hist[:, 1:], mean[:, step:step + 1]], 1)
            yield _rows(pdf, key, name, mean)

    return model_in.mapInPandas(run, schema)


def fc_arima(train: DataFrame, key: str = "item_id", date: str = "date", y: str = "sales_amount",
             p_max: int = 3, q_max: int = 2, season: int = 7, long_order: int = 14, h: int = 28,
             name: str = "arima") -> DataFrame:
    """ARMA(p, q) with an optional seasonal AR lag per series (Hannan-Rissanen)."""
    w = Window.partitionBy(key).orderBy(date)
    # stage 1: long AR(m) per series from one Gram aggregation; its residuals estimate the shocks
    m = long_order
    l1 = [f"_a{i}" for i in range(1, m + 1)]
    base = train.select(key, date, F.col(y).cast("double").alias("y"),
                        *[F.lag(y, i).over(w).cast("double").alias(c) for i, c in enumerate(l1, 1)])
    full = base.filter(F.col(l1[-1]).isNotNull())
    coef = gram.ols(gram.gram_sums(full, key, l1, "y"), key, m + 1).select(key, F.col("beta").alias("_b"))
    resid = base.join(coef, key, "left").select(key, date, "y", (F.col("y") - gram.dot("_b", l1)).alias("e"))
    # stage 2: regress y on its own lags, the seasonal lag and lagged residuals (common sample)
    ylags = [F.lag("y", i).over(w).alias(f"_l{i}") for i in range(1, p_max + 1)]
    elags = [F.lag("e", j).over(w).alias(f"_e{j}") for j in range(1, q_max + 1)]
    lg = resid.select(key, date, "y", "e", *ylags, F.lag("y", season).over(w).alias("_ls"), *elags)
    xs = [f"_l{i}" for i in range(1, p_max + 1)] + ["_ls"] + [f"_e{j}" for j in range(1, q_max + 1)]
    complete = [F.col(c).isNotNull() for c in ("y", "_ls", xs[-1])]
    sums = gram.gram_sums(lg.filter(complete[0] & complete[1] & complete[2]), key, xs, "y")
    # last `season` observations and last q residuals per series (bounded per series)
    keep = max(season, p_max, q_max)
    wd = Window.partitionBy(key).orderBy(F.col(date).desc())
    recent = F.when(F.col("rn") <= keep, F.struct(date, "y", "e"))
    tail = (resid.select(key, date, "y", "e", F.row_number().over(wd).alias("rn"))
            .groupBy(key).agg(F.max(date).alias("last_date"), F.avg("y").alias("_mean"), F.sort_array(F.collect_list(recent)).alias("tail")))
    model_in = tail.join(sums, key, "left")
    k_full = len(xs) + 1
    cands = [[0, *range(1, p + 1), *([p_max + 1] if seas else []), *range(p_max + 2, p_max + 2 + q)]
             for p, seas, q in itertools.product(range(p_max + 1), (False, True), range(q_max + 1))]
    schema = T.StructType([model_in.schema[key], T.StructField("date", T.DateType()),
                           T.StructField("model", T.StringType()), T.StructField("mean", T.DoubleType())])

    def run(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            xtx, xty, yty, n, none = _blocks(pdf, k_full)
            coefs = choose(xtx, xty, yty, n, cands)
            coefs[none, 0] = pdf["_mean"][none].to_numpy(float)
            hist, shocks = _histories(pdf["tail"], keep, "y"), _histories(pdf["tail"], keep, "e")
            mean = np.zeros((len(pdf), h))
            for step in range(h):
                x = np.concatenate([np.ones((len(pdf), 1)), hist[:, ::-1][:, :p_max], hist[:, -season][:, None], shocks[:, ::-1][:, :q_max]], 1)
                mean[:, step] = (coefs * x).sum(1)
                hist = np.concatenate([hist[:, 1:], mean[:, step:step + 1]], 1)
                shocks = np.concatenate([shocks[:, 1:], np.zeros((len(pdf), 1))], 1)
            yield _rows(pdf, key, name, mean)

    return model_in.mapInPandas(run, schema)
