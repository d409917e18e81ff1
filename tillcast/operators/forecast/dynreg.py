"""Regression with autocorrelated errors, per series.

Two-stage estimate (no likelihood library): (1) least squares of y on the
regressors from per-series Gram sums; (2) an AR(1) on the residuals from
two more sums per series. Forecast: beta' x_{T+h} + phi^h e_T.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.operators.forecast import gram

PHI_BOUND = 0.99


def fit(train: DataFrame, xcols: Sequence[str], key: str = "item_id", date: str = "date", y: str = "y",
        ridge: float = 1e-8) -> DataFrame:
    """key, beta, phi, e_last, last_date, n, sse."""
    sums = gram.gram_sums(train, key, xcols, y)
    coef = gram.ols(sums, key, len(xcols) + 1, ridge)
    resid = (train.join(coef.select(key, "beta"), key)
             .select(key, date, (F.col(y) - gram.dot("beta", xcols)).alias("e")))
    e1 = F.lag("e", 1).over(Window.partitionBy(key).orderBy(date))
    r = resid.select(key, date, "e", e1.alias("e1")).groupBy(key).agg(
        F.sum(F.col("e") * F.col("e1")).alias("s01"),
        F.sum(F.col("e1") * F.col("e1")).alias("s11"),
        F.max_by("e", date).alias("e_last"),
        F.max(date).alias("last_date"))
    phi = F.coalesce(F.try_divide(F.col("s01"), F.col("s11")), F.lit(0.0))
    phi = F.greatest(F.least(phi, F.lit(PHI_BOUND)), F.lit(-PHI_BOUND))
    return coef.join(r, key).select(key, "beta", phi.alias("phi"), "e_last", "last_date", "n", "sse")


def forecast(model: DataFrame, future: DataFrame, xcols: Sequence[str], name: str,
             key: str = "item_id", date: str = "date") -> DataFrame:
    f = future.join(model, key)
    h = F.datediff(F.col(date), F.col("last_date"))
    mean = gram.dot("beta", xcols) + F.pow(F.col("phi"), h) * F.col("e_last")
    return f.select(key, date, F.lit(name).alias("model"), mean.alias("mean"))


def fc_dynreg(train: DataFrame, future: DataFrame, xcols: Sequence[str], name: str, key: str = "item_id") -> DataFrame:
    return forecast(fit(train, xcols, key), future, xcols, name, key)
