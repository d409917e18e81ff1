"""Decomposable trend + seasonality + holiday model per series.

The design row of a date is built by expressions on the (small) calendar:
piecewise-linear trend with hinge changepoints, yearly and weekly Fourier
terms, one flag per holiday taken from the calendar's event names. Each
series is fitted from its Gram sums, with a penalty on the absolute change of
slope at every changepoint, so most of them stay unused, and forecast by
``beta' x`` on the future calendar rows. ``train`` must be dense (every item
has every training day, as the panel gives it).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.operators.forecast import gram
from tillcast.session import checked_broadcast, ship_package

# Fixed values of the design.
YEAR_DAYS = 365.25
YEARLY_ORDER = 4
WEEKLY_ORDER = 3
N_CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8
# Fixed value: scale of the slope changes, in largest values a training span.
CHANGEPOINT_SCALE = 0.05
RIDGE = 1e-7
#: Rounds of the noise variance; most sweeps of coordinate descent; slope left, in penalties, at which it stops.
NOISE_ROUNDS, SWEEPS, STILL = 4, 2000, 1e-6


def holiday_names(calendar: DataFrame) -> list[str]:
    """Every event name of the calendar (a handful of rows, whatever the sales)."""
    names = calendar.select(F.explode(F.array("event_name_1", "event_name_2")).alias("e")).where("e is not null").distinct()
    return sorted(r[0] for r in names.collect())


def design_columns(holidays: list[str]) -> list[str]:
    cols = ["t"] + [f"cp{j}" for j in range(1, N_CHANGEPOINTS + 1)]
    cols += [f"{f}_y{k}" for k in range(1, YEARLY_ORDER + 1) for f in ("sin", "cos")]
    cols += [f"{f}_w{k}" for k in range(1, WEEKLY_ORDER + 1) for f in ("sin", "cos")]
    cols += [f"hol_{h}" for h in holidays]
    return cols


def design(calendar: DataFrame, first_day: Column, train_end: Column, holidays: list[str] | None = None) -> DataFrame:
    """date + design columns; t in years since the first day; a flag for every event of the calendar."""
    holidays = holiday_names(calendar) if holidays is None else holidays
    days = F.datediff(F.col("date"), first_day).cast("double")
    span = F.datediff(train_end, first_day).cast("double")
    cols = [F.col("date"), (days / YEAR_DAYS).alias("t")]
    for j in range(1, N_CHANGEPOINTS + 1):
        c = span * CHANGEPOINT_RANGE * j / (N_CHANGEPOINTS + 1)
        cols.append((F.greatest(days - c, F.lit(0.0)) / YEAR_DAYS).alias(f"cp{j}"))
    for k in range(1, YEARLY_ORDER + 1):
        a = F.lit(2 * math.pi * k) * days / YEAR_DAYS
        cols += [F.sin(a).alias(f"sin_y{k}"), F.cos(a).alias(f"cos_y{k}")]
    for k in range(1, WEEKLY_ORDER + 1):
        a = F.lit(2 * math.pi * k) * days / 7.0
        cols += [F.sin(a).alias(f"sin_w{k}"), F.cos(a).alias(f"cos_w{k}")]
    for hname in holidays:
        hit = (F.col("event_name_1") == hname) | (F.col("event_name_2") == hname)
        cols.append(F.coalesce(hit.cast("int"), F.lit(0)).alias(f"hol_{hname}"))
    return calendar.select(*cols)


def _toward(gram_: np.ndarray, c: np.ndarray, penalty: np.ndarray, b: np.ndarray) -> np.ndarray:
    """From b towards the best values with its signs, up to the first coordinate that reaches 0."""
    on = b != 0
    system = gram_ * (on[:, :, None] & on[:, None, :]) + np.eye(len(gram_)) * np.where(on, 1e-12 * np.trace(gram_), 1.0)[:, None, :]
    best = np.linalg.solve(system, ((c - penalty[:, None] * np.sign(b)) * on)[:, :, None])[:, :, 0]
    step = best - b
    crossing = on & (b * best < 0)
    share = np.where(crossing, -b / np.where(crossing, step, 1.0), 2.0)
    first = share.min(1, keepdims=True)
    return np.where(crossing & (share == first), 0.0, b + np.minimum(first, 1.0) * step) * on


def lasso(gram_: np.ndarray, c: np.ndarray, penalty: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """Rows b that minimise b'Gb / 2 - c'b + penalty |b|_1, for all rows of c at once.

    Sweeps of coordinate descent choose signs; between them the coordinates in
    use move together to where those signs are best, which neighbouring
    changepoints need, as they are nearly the same column.
    """
    b = np.zeros_like(c) if start is None else start.copy()
    diagonal = np.diag(gram_)
    near = STILL * np.maximum(penalty, 1e-9 * np.abs(c).max(1, initial=0) + 1e-300)[:, None]
    for turn in range(SWEEPS):
        slope = c - b @ gram_  # what is left to explain
        off = np.where(b != 0, np.abs(slope - penalty[:, None] * np.sign(b)), np.maximum(np.abs(slope) - penalty[:, None], 0))
        if (off <= near).all():
            break
        for j in np.flatnonzero(diagonal > 1e-12):
            rho = slope[:, j] + diagonal[j] * b[:, j]
            new = np.sign(rho) * np.maximum(np.abs(rho) - penalty, 0) / diagonal[j]
            slope -= (new - b[:, j])[:, None] * gram_[j]
            b[:, j] = new
        if turn % 3 == 2:
            for _ in range(3):
                b = _toward(gram_, c, penalty, b)
    return b


def sparse_fit(xtx: np.ndarray, xty: np.ndarray, yty: np.ndarray, n: np.ndarray, top: np.ndarray, span: float, sparse: slice,
               scale: float = CHANGEPOINT_SCALE) -> np.ndarray:
    """Coefficients (series, columns) of all series over one X'X, the columns ``sparse`` under the absolute-value penalty.

    The other columns are solved for exactly and taken out, so the descent
    moves the changepoints alone. The penalty of a series is its noise variance
    times ``span`` (years) over ``scale`` times its largest value ``top``; the variance
    starts at that of the unpenalised fit and is taken again from every fit.
    """
    k = len(xtx)
    rest = np.ones(k, bool)
    rest[sparse] = False
    free = xtx[np.ix_(rest, rest)]
    free = free + RIDGE * np.trace(xtx) / k * np.eye(len(free))
    across = np.linalg.solve(free, xtx[np.ix_(rest, ~rest)])
    g = xtx[np.ix_(~rest, ~rest)] - xtx[np.ix_(~rest, rest)] @ across
    c = xty[:, ~rest] - xty[:, rest] @ across
    beta = np.zeros_like(xty)

    def put(delta):
        beta[:, ~rest] = delta
        beta[:, rest] = np.linalg.solve(free, (xty[:, rest] - delta @ xtx[np.ix_(~rest, rest)]).T).T
        sse = yty - 2 * (beta * xty).sum(1) + np.einsum("bi,ij,bj->b", beta, xtx, beta)
        return np.maximum(sse, 1e-9 * np.maximum(yty, 1e-9)) / n

    noise = put(c @ np.linalg.pinv(g, rcond=1e-10, hermitian=True))
    delta = np.zeros_like(c)
    for _ in range(NOISE_ROUNDS):
        delta = lasso(g, c, noise * span / (scale * np.maximum(top, 1e-9)), delta)
        noise = put(delta)
    return beta


def shared_gram(rows: DataFrame, xcols: list[str]) -> DataFrame:
    """One row (xtx, the packed upper triangle with intercept): sums of each partition, added up by place.

    ``rows`` are days of the calendar; a thousand sums are too many for one generated aggregate."""
    at = np.triu_indices(len(xcols) + 1)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(xcols) + 1, len(xcols) + 1))
        for pdf in batches:
            x = np.column_stack([np.ones(len(pdf)), pdf.to_numpy(float)])
            total += x.T @ x
        yield pd.DataFrame({"place": np.arange(len(at[0])), "value": total[at]})

    sums = rows.select(*xcols).mapInPandas(partial, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    return sums.agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda s: s["value"]).alias("xtx"))


def fit(sums: DataFrame, key: str, span: Column) -> DataFrame:
    """key, beta from rows (key, xty, yty, n, top) that share one X'X (``xtx``)."""
    ship_package(sums.sparkSession)
    schema = T.StructType([sums.schema[key], T.StructField("beta", T.ArrayType(T.DoubleType()))])

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            xty = np.stack(pdf["xty"].to_numpy()).astype(float)
            xtx = gram.unpack(np.asarray(pdf["xtx"].iloc[0], float)[None], xty.shape[1])[0]
            beta = sparse_fit(xtx, xty, pdf["yty"].to_numpy(float), pdf["n"].to_numpy(float), pdf["top"].to_numpy(float),
                              float(pdf["span"].iloc[0]), slice(2, 2 + N_CHANGEPOINTS))
            yield pd.DataFrame({key: pdf[key], "beta": list(beta)})

    return sums.select(key, "xtx", "xty", "yty", "n", "top", span.cast("double").alias("span")).mapInPandas(solve, schema)


def fc_decomposable(train: DataFrame, calendar: DataFrame, first_day: Column, train_end: Column,
                    h: int = 28, key: str = "item_id", y: str = "sales_amount", name: str = "decomposable") -> DataFrame:
    holidays = holiday_names(calendar)
    xcols = design_columns(holidays)
    rows = design(calendar, first_day, train_end, holidays)
    des = checked_broadcast(rows)
    # All series cover the same training days, so X'X is one small sum over the calendar; only X'y is per item.
    shared = shared_gram(rows.where(F.col("date") <= train_end), xcols)
    top = F.max(F.abs(F.col(y).cast("double"))).alias("top")
    sums = gram.cross_sums(train.join(des, "date"), key, xcols, y, top).withColumn("xtx", shared.select("xtx").scalar())
    coef = fit(sums, key, F.datediff(train_end, first_day) / YEAR_DAYS)
    last = train.groupBy(key).agg(F.max("date").alias("last_date"))
    grid = last.select(key, F.explode(F.sequence(F.date_add("last_date", 1), F.date_add("last_date", h))).alias("date"))
    fut = grid.join(des, "date").join(coef.select(key, "beta"), key)
    return fut.select(key, "date", F.lit(name).alias("model"), gram.dot("beta", xcols).alias("mean"))
