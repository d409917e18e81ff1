"""Joins that enrich the panel.

Broadcast hints are given only to sides whose size is bounded by the
number of calendar days (calendar, date sets, the weekly calendar), never
to sides that grow with items or facts; those are left to the planner's
size threshold and AQE's runtime conversion. Even the bounded sides go
through ``checked_broadcast``, which hints only below a size cap taken from
the optimizer's estimate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions import dates as D
from tillcast.session import checked_broadcast


def with_calendar(facts: DataFrame, calendar: DataFrame, on: str = "date", how: str = "inner") -> DataFrame:
    """Facts x calendar on date (J1/J3); the calendar is one row per day."""
    return facts.join(checked_broadcast(calendar), on, how)


def with_price(panel: DataFrame, prices: DataFrame, key: str = "item_id", week: str = "wm_yr_wk") -> DataFrame:
    """Left join of the weekly price on (item, week)."""
    return panel.join(prices.select(key, week, "sell_price"), [key, week], "left")


def with_price_by_item(panel: DataFrame, prices: DataFrame, key: str = "item_id", week: str = "wm_yr_wk",
                       date: str = "date") -> DataFrame:
    """Weekly price looked up without a join (J4, co-partitioned form).

    Price rows are unioned into the panel, the union is hash-partitioned by
    item once, and a window over (item, week) spreads the week's price to
    its days. The same exchange by item then serves every later per-item
    window (lags, percent changes, first dates), so the panel is shuffled
    once instead of once for an (item, week) join and again for the
    windows. Rows per item are bounded by the calendar, so hashing on item
    alone cannot create a hot partition.

    The partition count is explicit (the session's shuffle partitions): when
    panel and prices already come hash-partitioned by item that way (as the
    panel source produces them), Spark drops both repartitions and the lookup
    moves no data at all.
    """
    n = int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    p = prices.select(key, week, F.col("sell_price").alias("_price")).repartition(n, key)
    u = panel.withColumn("_price", F.lit(None).cast("double")).unionByName(p, allowMissingColumns=True)
    u = u.repartition(n, key).withColumn("sell_price", F.max("_price").over(Window.partitionBy(key, week)))
    return u.filter(F.col(date).isNotNull()).drop("_price")


def first_date_flag(panel: DataFrame, cond, key: str = "item_id", date: str = "date",
                    out: str = "week_added") -> DataFrame:
    """1 on the first date where ``cond`` holds for the item, else 0.

    A window minimum replaces the group-then-join of the study.
    """
    w = Window.partitionBy(key)
    first = F.min(F.when(cond, F.col(date))).over(w)
    return panel.withColumn(out, F.coalesce((F.col(date) == first).cast("int"), F.lit(0)))


def calendar_lags_leads(calendar: DataFrame, flag: str, lags=(1, 2, 3), leads=(1, 2, 3), date: str = "date") -> DataFrame:
    """Lag / lead copies of a calendar flag, first / last value as default.

    The only un-partitioned window in the library: its input is one row per
    calendar day, bounded by the date range, not by the data volume.
    """
    w = Window.orderBy(date)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first, last = F.first(flag).over(whole), F.last(flag).over(whole)
    cols = [F.coalesce(F.lag(flag, k).over(w), first).alias(f"{flag}_lag{k}") for k in lags]
    cols += [F.coalesce(F.lead(flag, k).over(w), last).alias(f"{flag}_lead{k}") for k in leads]
    return calendar.select("*", *cols)


def day_after(calendar: DataFrame, event_dates: DataFrame, out: str, date: str = "date") -> DataFrame:
    """Flag days that follow a date of ``event_dates`` (P10)."""
    shifted = event_dates.select(F.date_add(F.col(date), 1).alias(date)).distinct().withColumn(out, F.lit(1))
    return calendar.join(checked_broadcast(shifted), date, "left").withColumn(out, F.coalesce(F.col(out), F.lit(0)))


def year_ago(grid: DataFrame, calendar: DataFrame, col: str, date: str = "date", out: str | None = None) -> DataFrame:
    """Value of a calendar column on the same date one year earlier.

    Looked up backwards (``add_months(date, -12)``) so 29 February maps to
    28 February instead of duplicating rows.
    """
    out = out or f"{col}_year_ago"
    cal = calendar.select(F.col(date).alias("_ago"), F.col(col).alias(out))
    return (grid.withColumn("_ago", F.add_months(F.col(date), -12))
            .join(checked_broadcast(cal), "_ago", "left").drop("_ago"))


def period_mean_join(panel: DataFrame, value: str, period: str, key: str = "item_id", date: str = "date",
                     out: str | None = None) -> DataFrame:
    """Mean of ``value`` per (item, period) on every row of the period.

    A window in place of group and join back: it reuses the panel's
    partitioning by item, so nothing moves.
    """
    out = out or f"{period}_mean_{value}"
    n = int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_item = panel.repartition(n, key).withColumn("_p", D.period_start(date, period))
    return by_item.withColumn(out, F.avg(value).over(Window.partitionBy(key, "_p"))).drop("_p")
