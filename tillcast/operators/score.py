"""Forecast scoring: per-item, per-day and pooled errors (M1-M9).

Forecasts (``key, date, model, mean``) are aligned to actuals by a keyed
join, never by row position. All metrics are grouped aggregations with
partial aggregation before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the MAPE denominator floor (machine epsilon of float64).
EPS = 2.220446049250313e-16


def align(forecast: DataFrame, actual: DataFrame, key="item_id", date="date", y="sales_amount",
          how: str = "inner", fill_missing: float | None = None) -> DataFrame:
    """Join forecasts to actuals on (key, date): columns key, date, model, y, yhat."""
    a = actual.select(key, date, F.col(y).alias("y"))
    j = forecast.join(a, [key, date], how)
    yhat = F.col("mean")
    if fill_missing is not None:
        yhat = F.coalesce(yhat, F.lit(float(fill_missing)))
    return j.select(key, date, "model", "y", yhat.alias("yhat"))


def _err() -> Column:
    return F.col("y") - F.col("yhat")


def rmse_per_item(aligned: DataFrame, key="item_id") -> DataFrame:
    return (aligned.filter(F.col("y").isNotNull() & F.col("yhat").isNotNull())
            .groupBy("model", key).agg(F.sqrt(F.avg(F.pow(_err(), 2))).alias("rmse")))


def rmse_per_item_mean(aligned: DataFrame, key="item_id") -> DataFrame:
    """RMSE per item, then the mean over items, per model (M1/M2)."""
    return (rmse_per_item(aligned, key).filter(F.col("rmse").isNotNull())
            .groupBy("model").agg(F.avg("rmse").alias("rmse"), F.count("*").alias("n_items")))


def rmse_per_day_mean(aligned: DataFrame, date="date") -> DataFrame:
    """RMSE per day across items, then the mean over days (M3)."""
    per_day = aligned.groupBy("model", date).agg(F.sqrt(F.avg(F.pow(_err(), 2))).alias("rmse_day"))
    return per_day.groupBy("model").agg(F.avg("rmse_day").alias("rmse_per_day"), F.count("*").alias("n_days"))


def mape_parts() -> list[Column]:
    """MAPE = mean(|e| / max(|y|, eps)) as two sums and a count.

    On rows with y = 0 the term is |e| / eps = |e| * 2^52, so that part is
    kept as a plain sum of |e| and scaled once at the end (exact, since eps
    is a power of two); rows with y != 0 are summed apart.
    """
    e, y = F.abs(_err()), F.abs(F.col("y"))
    zero = y < F.lit(EPS)
    return [F.sum(F.when(zero, e).otherwise(F.lit(0.0))).alias("_mape_big"),
            F.sum(F.when(~zero, e / y).otherwise(F.lit(0.0))).alias("_mape_small"),
            F.count("*").alias("_mape_n")]


def mape_value(big: Column | str = "_mape_big", small: Column | str = "_mape_small", n: Column | str = "_mape_n") -> Column:
    big, small, n = (F.col(c) if isinstance(c, str) else c for c in (big, small, n))
    return big * F.lit(1.0 / EPS) / n + small / n


def poisson_deviance() -> Column:
    """Mean Poisson deviance; undefined (NULL) if any prediction is not > 0."""
    y, p = F.col("y"), F.col("yhat")
    dev = 2 * (F.when(y > 0, y * F.log(F.try_divide(y, p))).otherwise(F.lit(0.0)) - y + p)
    return F.when(F.count_if(p <= 0) > 0, F.lit(None).cast("double")).otherwise(F.avg(dev))


def pooled_errors(aligned: DataFrame) -> DataFrame:
    """Pooled MAE, MSE, RMSE, weighted APE, MAPE (floored denominator) and Poisson deviance (M4-M6)."""
    e = _err()
    out = aligned.groupBy("model").agg(
        F.avg(F.abs(e)).alias("mae"),
        F.avg(F.pow(e, 2)).alias("mse"),
        F.sqrt(F.avg(F.pow(e, 2))).alias("rmse_pooled"),
        poisson_deviance().alias("poisson_deviance"),
        (F.sum(F.abs(e)) / F.sum(F.abs("y"))).alias("wape"),
        F.count("*").alias("n"),
        *mape_parts(),
    )
    return out.withColumn("mape", mape_value()).drop("_mape_big", "_mape_small", "_mape_n")


def negative_forecasts(forecast: DataFrame, key="item_id") -> DataFrame:
    """Per model: items negative on every day, and the count of negative rows (M8)."""
    per_item = forecast.groupBy("model", key).agg(
        F.bool_and(F.col("mean") < 0).alias("all_neg"),
        F.count_if(F.col("mean") < 0).alias("neg_rows"))
    return per_item.groupBy("model").agg(
        F.count_if("all_neg").alias("items_all_negative"),
        F.sum("neg_rows").cast("bigint").alias("negative_rows"))


def every_model(actual: DataFrame, models: list, key="item_id", date="date", y="sales_amount") -> DataFrame:
    """Actuals once for each model (a bounded list of names)."""
    return actual.select(key, date, F.col(y).alias("y"), F.explode(F.array(*[F.lit(m) for m in models])).alias("model"))


def models_of(forecast: DataFrame) -> list:
    """Names of the models, one short row each."""
    return sorted(r[0] for r in forecast.select("model").distinct().collect())


def leaderboard(forecast: DataFrame, actual: DataFrame, key="item_id", date="date", y="sales_amount",
                models: list | None = None) -> DataFrame:
    """One row per model, all three RMSEs, absent and null forecasts scored as 0 and counted (M7).

    Every model is held against every actual (item, date). The aligned rows
    are summed once, by (model, item) and (model, date) together; the board
    is an aggregate of those sums. ``models`` (default: those with a row in
    ``forecast``) may name models whose forecasts are all absent.
    """
    models = models_of(forecast) if models is None else models
    if not models:
        models = [None]
    grid = every_model(actual, models, key, date, y)
    aligned = grid.join(forecast.select("model", key, date, "mean"), ["model", key, date], "left")
    e = F.col("y") - F.coalesce("mean", F.lit(0.0))
    sums = aligned.groupingSets([[F.col("model"), F.col(key)], [F.col("model"), F.col(date)]], "model", key, date).agg(
        F.sum(e * e).alias("sse"), F.sum(F.abs(e)).alias("sae"), F.count("*").alias("n"),
        F.count_if(F.col("mean").isNull()).alias("absent"), F.grouping(key).alias("by_day"))
    rmse, item, day = F.sqrt(F.col("sse") / F.col("n")), F.col("by_day") == 0, F.col("by_day") == 1
    of_items = lambda c: F.sum(F.when(item, F.col(c)))
    return (sums.where("model is not null").groupBy("model").agg(
        F.avg(F.when(item, rmse)).alias("rmse"), F.count_if(item).alias("n_items"),
        F.avg(F.when(day, rmse)).alias("rmse_per_day"), F.count_if(day).alias("n_days"),
        F.sqrt(of_items("sse") / of_items("n")).alias("rmse_pooled"), (of_items("sae") / of_items("n")).alias("mae"),
        of_items("absent").alias("n_absent")).orderBy("rmse"))
