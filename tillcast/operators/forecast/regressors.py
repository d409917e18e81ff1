"""Regressor tables for the per-series statistical models.

Training rows: item, date, y and calendar / price regressors. Future rows:
the horizon grid with the same regressors, prices held at their last known
value (and the lagged price at the value ``n_back`` rows from the end).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.operators import enrich, features
from tillcast.session import checked_broadcast, reliable_checkpoint

BASE_X = ["sell_price", "snap_TX", "wday", "month", "day_of_month", "event"]
LAG_X = ["sell_price_lag_7", "event_lag1", "event_lead1", "event_lead2", "event_lead3"]

# Fixed value: the study takes the 9th row from the end as the constant lagged price.
N_BACK = 9


def calendar_regressors(calendar: DataFrame) -> DataFrame:
    """date, wday, month, day_of_month, snap_TX, event and event lag 1 / leads 1-3."""
    ev = calendar.select("date", "wday", "month", F.dayofmonth("date").alias("day_of_month"), "snap_TX",
                         F.when(F.col("event_name_1").isNotNull(), 1).otherwise(0).alias("event"))
    return enrich.calendar_lags_leads(ev, "event", lags=(1,), leads=(1, 2, 3))


def train_regressors(sales: DataFrame, calendar: DataFrame, prices: DataFrame, train_end: Column,
                     key: str = "item_id", materialize: bool = True) -> DataFrame:
    """Training table: y plus all regressors; price forward-filled per item,
    0 before the item's first price.

    The price lookup, forward fill and lag share one exchange by item. With
    ``materialize`` the table is checkpointed into the shared folder: model
    fitting reads it three times (Gram sums, residuals, future rows), and
    none of those re-derives the panel from the facts.
    """
    cal = calendar_regressors(calendar)
    weeks = calendar.select("date", "wm_yr_wk")
    panel = sales.filter(F.col("date") <= train_end).join(checked_broadcast(weeks), "date")
    panel = enrich.with_price_by_item(panel, prices.select(key, "wm_yr_wk", "sell_price"), key)
    panel = panel.withColumn("sell_price", F.coalesce(features.forward_fill("sell_price", key), F.lit(0.0)))
    panel = panel.withColumn("sell_price_lag_7", features.lag_first_filled("sell_price", 7, key))
    out = panel.join(checked_broadcast(cal), "date").select(
        key, "date", F.col("sales_amount").alias("y"), *BASE_X, *LAG_X)
    return reliable_checkpoint(out) if materialize else out


def future_regressors(train_reg: DataFrame, calendar: DataFrame, horizon: int = 28,
                      key: str = "item_id", n_back: int = N_BACK) -> DataFrame:
    """Horizon grid per item with last price, constant lagged price and calendar regressors."""
    w = Window.partitionBy(key).orderBy(F.col("date").desc())
    tail = (train_reg.select(key, "date", "sell_price", F.row_number().over(w).alias("rn"))
            .filter(F.col("rn") <= n_back))
    last = tail.groupBy(key).agg(
        F.max("date").alias("last_date"),
        F.max_by("sell_price", "date").alias("last_price"),
        F.max(F.when(F.col("rn") == n_back, F.col("sell_price"))).alias("lag_price"))
    grid = last.select(key, "last_price", "lag_price",
                       F.explode(F.sequence(F.date_add("last_date", 1), F.date_add("last_date", horizon))).alias("date"))
    cal = calendar_regressors(calendar)
    return grid.join(checked_broadcast(cal), "date").select(
        key, "date", F.col("last_price").alias("sell_price"), "snap_TX", "wday", "month", "day_of_month", "event",
        F.col("lag_price").alias("sell_price_lag_7"), "event_lag1", "event_lead1", "event_lead2", "event_lead3")
