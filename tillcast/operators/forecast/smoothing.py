"""Exponential smoothing per series, with automatic form choice.

Each series becomes one ordered array (bounded by the number of days in
the history, not by the data volume) and the smoothing recursion runs as a
JVM ``aggregate`` fold - no Python per row. The parameter grid sits on the
row axis (``explode``), so every (series, setting) fold is its own small
task-local computation; the best setting per series and form is picked by
``min_by`` on the one-step SSE, and the form by AICc.

Forms: simple (level), Holt (level + trend), additive Holt-Winters with a
weekly season.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The parameter grids searched per form.
ALPHAS = [0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9]
BETAS = [0.01, 0.05, 0.1, 0.2]
GAMMAS = [0.01, 0.05, 0.1, 0.2]
SEASON = 7


def series_arrays(train: DataFrame, key: str, date: str, y: str) -> DataFrame:
    s = train.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct(F.col(date).alias("d"), F.col(y).cast("double").alias("v")))).alias("s"),
        F.max(date).alias("last_date"))
    return s.select(key, "last_date", F.transform("s", lambda x: x["v"]).alias("ys"))


def _ses_fold(ys, alpha):
    init = F.struct(F.element_at(ys, 1).alias("l"), F.lit(0.0).alias("sse"))
    return F.aggregate(
        ys, init,
        lambda acc, v: F.struct((alpha * v + (1 - alpha) * acc["l"]).alias("l"),
                                (acc["sse"] + (v - acc["l"]) * (v - acc["l"])).alias("sse")))


def _holt_fold(ys, alpha, beta):
    init = F.struct(F.element_at(ys, 1).alias("l"), F.lit(0.0).alias("b"), F.lit(0.0).alias("sse"))

    def step(acc, v):
        f = acc["l"] + acc["b"]
        lvl = alpha * v + (1 - alpha) * f
        return F.struct(lvl.alias("l"), (beta * (lvl - acc["l"]) + (1 - beta) * acc["b"]).alias("b"),
                        (acc["sse"] + (v - f) * (v - f)).alias("sse"))

    return F.aggregate(ys, init, step)


def _hw_fold(ys, alpha, beta, gamma):
    init = F.struct(F.element_at(ys, 1).alias("l"), F.lit(0.0).alias("b"),
                    F.array_repeat(F.lit(0.0), SEASON).alias("s"), F.lit(0).alias("i"), F.lit(0.0).alias("sse"))

    def step(acc, v):
        slot = acc["i"] % SEASON
        s_old = F.element_at(acc["s"], slot + 1)
        f = acc["l"] + acc["b"] + s_old
        lvl = alpha * (v - s_old) + (1 - alpha) * (acc["l"] + acc["b"])
        trend = beta * (lvl - acc["l"]) + (1 - beta) * acc["b"]
        s_new = gamma * (v - lvl) + (1 - gamma) * s_old
        season = F.transform(acc["s"], lambda x, j: F.when(j == slot, s_new).otherwise(x))
        return F.struct(lvl.alias("l"), trend.alias("b"), season.alias("s"), (acc["i"] + 1).alias("i"),
                        (acc["sse"] + (v - f) * (v - f)).alias("sse"))

    return F.aggregate(ys, init, step)


def _aicc(sse: str, n: str, k: str):
    """AICc = n log(SSE/n) + 2k + 2k(k+1)/(n-k-1)."""
    nn, kk = F.col(n).cast("double"), F.col(k).cast("double")
    corr = F.coalesce(F.try_divide(2 * kk * (kk + 1), nn - kk - 1), F.lit(0.0))
    return nn * F.log(F.greatest(F.col(sse), F.lit(1e-12)) / nn) + 2 * kk + corr


def fit(train: DataFrame, key: str = "item_id", date: str = "date", y: str = "sales_amount",
        forms=("ses", "holt", "hw")) -> DataFrame:
    """Best setting per series and form, then the best form by AICc.

    Columns: key, last_date, form, l, b, s (season array), i, aicc.
    """
    arr = series_arrays(train, key, date, y).withColumn("n", F.size("ys"))
    parts = []
    if "ses" in forms:
        g = arr.select("*", F.explode(F.array(*[F.lit(a) for a in ALPHAS])).alias("alpha"))
        r = g.select(key, "last_date", "n", _ses_fold(F.col("ys"), F.col("alpha")).alias("st"))
        parts.append(r.select(key, "last_date", "n", F.lit("ses").alias("form"), F.col("st.l").alias("l"),
                              F.lit(0.0).alias("b"), F.array_repeat(F.lit(0.0), SEASON).alias("s"),
                              F.col("n").alias("i"), F.col("st.sse").alias("sse"), F.lit(2).alias("k")))
    if "holt" in forms:
        grid = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in itertools.product(ALPHAS, BETAS)]
        g = arr.select("*", F.explode(F.array(*grid)).alias("p"))
        r = g.select(key, "last_date", "n", _holt_fold(F.col("ys"), F.col("p.a"), F.col("p.b")).alias("st"))
        parts.append(r.select(key, "last_date", "n", F.lit("holt").alias("form"), F.col("st.l").alias("l"),
                              F.col("st.b").alias("b"), F.array_repeat(F.lit(0.0), SEASON).alias("s"),
                              F.col("n").alias("i"), F.col("st.sse").alias("sse"), F.lit(4).alias("k")))
    if "hw" in forms:
        grid = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(c).alias("c"))
                for a, b, c in itertools.product(ALPHAS, BETAS, GAMMAS)]
        g = arr.select("*", F.explode(F.array(*grid)).alias("p"))
        r = g.select(key, "last_date", "n",
                     _hw_fold(F.col("ys"), F.col("p.a"), F.col("p.b"), F.col("p.c")).alias("st"))
        parts.append(r.select(key, "last_date", "n", F.lit("hw").alias("form"), F.col("st.l").alias("l"),
                              F.col("st.b").alias("b"), F.col("st.s").alias("s"), F.col("st.i").alias("i"),
                              F.col("st.sse").alias("sse"), F.lit(4 + SEASON).alias("k")))
    allp = parts[0]
    for p in parts[1:]:
        allp = allp.unionByName(p)
    allp = allp.withColumn("aicc", _aicc("sse", "n", "k"))
    best = allp.groupBy(key).agg(F.min_by(F.struct(*[c for c in allp.columns if c != key]), "aicc").alias("m"))
    return best.select(key, "m.*")


def forecast(model: DataFrame, h: int = 28, key: str = "item_id", name: str = "ets") -> DataFrame:
    g = model.select("*", F.explode(F.sequence(F.lit(1), F.lit(h))).alias("step"))
    slot = (F.col("i") + F.col("step") - 1) % SEASON
    mean = F.col("l") + F.col("step") * F.col("b") + F.element_at(F.col("s"), slot + 1)
    return g.select(key, F.date_add("last_date", F.col("step")).alias("date"), F.lit(name).alias("model"),
                    mean.alias("mean"))


def fc_ses(train: DataFrame, key="item_id", date="date", y="sales_amount", h=28) -> DataFrame:
    return forecast(fit(train, key, date, y, forms=("ses",)), h, key, "ses")


def fc_ets(train: DataFrame, key="item_id", date="date", y="sales_amount", h=28) -> DataFrame:
    return forecast(fit(train, key, date, y), h, key, "ets")


# -- grouped-map path -------------------------------------------------------
# Spark's higher-order functions are interpreted, not code-generated, so a
# fold of ~2,500 steps x 77 settings per series is slow on the JVM. The
# grouped-map path gives each series (at most one row per day, so bounded by
# the calendar) to an Arrow batch and runs every setting of a form as one
# vectorized numpy recursion - the same recursions, initial states and AICc
# choice as ``fit`` above.

def _fold_numpy(y: np.ndarray, alpha, beta=None, gamma=None):
    g = alpha.shape[0]
    lvl = np.full(g, y[0])
    b = np.zeros(g)
    s = np.zeros((g, SEASON))
    sse = np.zeros(g)
    rows = np.arange(g)
    for i, v in enumerate(y):
        slot = i % SEASON
        s_old = s[:, slot] if gamma is not None else 0.0
        f = lvl + b + s_old
        sse += (v - f) ** 2
        if gamma is not None:
            new_l = alpha * (v - s_old) + (1 - alpha) * (lvl + b)
        else:
            new_l = alpha * v + (1 - alpha) * (lvl + b)
        if beta is not None:
            b = beta * (new_l - lvl) + (1 - beta) * b
        if gamma is not None:
            s[rows, slot] = gamma * (v - new_l) + (1 - gamma) * s_old
        lvl = new_l
    return lvl, b, s, sse


def _aicc_np(sse, n, k):
    corr = 2.0 * k * (k + 1) / (n - k - 1) if n - k - 1 > 0 else 0.0
    return n * np.log(np.maximum(sse, 1e-12) / n) + 2 * k + corr


def ets_series(y: np.ndarray, h: int, forms=("ses", "holt", "hw")):
    """Best (form, setting) by AICc for one series; returns the h-step forecast."""
    n = len(y)
    cands = []
    if "ses" in forms:
        a = np.array(ALPHAS)
        lvl, b, s, sse = _fold_numpy(y, a)
        cands.append((_aicc_np(sse, n, 2), lvl, np.zeros_like(b), np.zeros((len(a), SEASON))))
    if "holt" in forms:
        ab = np.array(list(itertools.product(ALPHAS, BETAS)))
        lvl, b, s, sse = _fold_numpy(y, ab[:, 0], ab[:, 1])
        cands.append((_aicc_np(sse, n, 4), lvl, b, np.zeros((len(ab), SEASON))))
    if "hw" in forms:
        abc = np.array(list(itertools.product(ALPHAS, BETAS, GAMMAS)))
        lvl, b, s, sse = _fold_numpy(y, abc[:, 0], abc[:, 1], abc[:, 2])
        cands.append((_aicc_np(sse, n, 4 + SEASON), lvl, b, s))
    best = None
    for score, lvl, b, s in cands:
        j = int(np.argmin(score))
        if best is None or score[j] < best[0]:
            best = (score[j], lvl[j], b[j], s[j])
    _, lvl, b, s = best
    steps = np.arange(1, h + 1)
    return lvl + steps * b + s[(n + steps - 1) % SEASON]


def fc_ets_grouped(train: DataFrame, key="item_id", date="date", y="sales_amount", h=28,
                   name="ets") -> DataFrame:
    """Automatic exponential smoothing per series as a grouped map over Arrow batches."""
    schema = T.StructType([train.schema[key], T.StructField("date", T.DateType()),
                           T.StructField("model", T.StringType()), T.StructField("mean", T.DoubleType())])

    def per_series(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(date)
        vals = pdf[y].to_numpy(dtype=float)
        fc = ets_series(vals, h)
        last = pd.Timestamp(pdf[date].iloc[-1])
        dates = [(last + pd.Timedelta(days=i)).date() for i in range(1, h + 1)]
        return pd.DataFrame({key: pdf[key].iloc[0], "date": dates, "model": name, "mean": fc})

    return train.select(key, date, y).groupBy(key).applyInPandas(per_series, schema)
