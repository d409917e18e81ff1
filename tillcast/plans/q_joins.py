"""Queries: joins that enrich the panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.operators import enrich, reshape, score
from tillcast.operators.forecast import naive
from tillcast.plans.oracle import with_panel
from tillcast.plans.q_forecast import SNAIVE_CTES
from tillcast.plans.q_reshape import _ENRICHED, enriched, sales_wide
from tillcast.plans.registry import query
from tillcast.sources.panel import SalesPanel
from tillcast.session import checked_broadcast


@query("join_calendar", with_panel("SELECT * FROM sales JOIN calendar USING (date)"))
def join_calendar(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    return enrich.with_calendar(p.sales(), p.calendar())


@query("join_day_label", with_panel("""
SELECT i.id, 'd_' || CAST(date_diff('day', b.lo, t.date) + 1 AS VARCHAR) AS Day, t.sales_amount AS sales,
       c.date, c.wm_yr_wk, c.snap_TX
FROM sales t JOIN items i USING (item_id) CROSS JOIN bounds b
LEFT JOIN calendar c ON c.d = 'd_' || CAST(date_diff('day', b.lo, t.date) + 1 AS VARCHAR)"""))
def join_day_label(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    long = reshape.melt(sales_wide(p), ["id"], prefix="d_", var_name="Day", value_name="sales")
    cal = p.calendar().select("d", "date", "wm_yr_wk", "snap_TX")
    return long.join(checked_broadcast(cal), long["Day"] == cal["d"], "left").drop("d")


@query("join_price", with_panel(
    "SELECT item_id, date, wm_yr_wk, sales_amount, sell_price FROM enriched", _ENRICHED))
def join_price(spark, sf_dir):
    return enriched(SalesPanel(spark, sf_dir)).select("item_id", "date", "wm_yr_wk", "sales_amount", "sell_price")


@query("flag_first_date", with_panel("""
SELECT item_id, date,
  CASE WHEN date = min(CASE WHEN sell_price IS NOT NULL THEN date END) OVER (PARTITION BY item_id) THEN 1 ELSE 0 END AS week_added
FROM enriched WHERE date <= (SELECT hi - 28 FROM bounds)""", _ENRICHED))
def flag_first_date(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    e = enriched(p).filter(F.col("date") <= p.train_end())
    return enrich.first_date_flag(e, F.col("sell_price").isNotNull()).select("item_id", "date", "week_added")


_LAST_PRICE = """
last_price AS (SELECT item_id, arg_max(sell_price, wm_yr_wk) AS last_price FROM prices
               WHERE wm_yr_wk <= (SELECT CAST(10000 + floor(date_diff('day', DATE '1994-12-31', hi - 28) / 7) AS INTEGER) FROM bounds) GROUP BY item_id)"""


@query("attach_last_price", with_panel("""
SELECT i.item_id, s.date, l.last_price FROM items i CROSS JOIN spine s LEFT JOIN last_price l USING (item_id)
WHERE s.date >= (SELECT hi - 27 FROM bounds)""", _LAST_PRICE))
def attach_last_price(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    e = enriched(p).filter((F.col("date") <= p.train_end()) & F.col("sell_price").isNotNull())
    last = e.groupBy("item_id").agg(F.max_by("sell_price", "date").alias("last_price"))
    return p.test().select("item_id", "date").join(last, "item_id", "left")


@query("event_lags", with_panel("""
SELECT date, event,
  coalesce(lag(event, 1) OVER w, first_value(event) OVER wa) AS event_lag1,
  coalesce(lag(event, 2) OVER w, first_value(event) OVER wa) AS event_lag2,
  coalesce(lag(event, 3) OVER w, first_value(event) OVER wa) AS event_lag3,
  coalesce(lead(event, 1) OVER w, last_value(event) OVER wa) AS event_lead1,
  coalesce(lead(event, 2) OVER w, last_value(event) OVER wa) AS event_lead2,
  coalesce(lead(event, 3) OVER w, last_value(event) OVER wa) AS event_lead3
FROM (SELECT date, CASE WHEN event_name_1 IS NOT NULL THEN 1 ELSE 0 END AS event FROM calendar)
WINDOW w AS (ORDER BY date), wa AS (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""))
def event_lags(spark, sf_dir):
    cal = SalesPanel(spark, sf_dir).calendar_scan()
    ev = cal.select("date", F.when(F.col("event_name_1").isNotNull(), 1).otherwise(0).alias("event"))
    return enrich.calendar_lags_leads(ev, "event")


@query("join_period", with_panel("""
SELECT s.item_id, s.date, s.sales_amount, round(m.month_mean_sales, 6) AS month_mean_sales
FROM sales s JOIN (SELECT item_id, date_trunc('month', date) AS p, avg(sales_amount) AS month_mean_sales
                   FROM sales GROUP BY ALL) m
  ON m.item_id = s.item_id AND m.p = date_trunc('month', s.date)"""))
def join_period(spark, sf_dir):
    s = SalesPanel(spark, sf_dir).sales()
    j = enrich.period_mean_join(s, "sales_amount", "month", out="month_mean_sales")
    return j.withColumn("month_mean_sales", F.round("month_mean_sales", 6))


@query("join_actual_pred", with_panel("""
SELECT f.item_id, f.date, f.model, t.sales_amount AS y, f.mean AS yhat FROM snaive f JOIN test t USING (item_id, date)""",
                                      SNAIVE_CTES))
def join_actual_pred(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    return score.align(naive.fc_snaive(p.train()), p.test())


@query("semi_dates", with_panel("""
SELECT * FROM sales s WHERE s.date IN (SELECT date FROM calendar WHERE event_name_1 IS NOT NULL)"""))
def semi_dates(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    days = p.calendar().filter(F.col("event_name_1").isNotNull()).select("date")
    return p.sales().join(checked_broadcast(days), "date", "left_semi")


@query("yearago_snap", with_panel("""
SELECT t.item_id, t.date, c.snap_TX AS snap_TX_year_ago
FROM test t LEFT JOIN calendar c ON c.date = CAST(t.date - INTERVAL 1 YEAR AS DATE)"""))
def yearago_snap(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    return enrich.year_ago(p.test().select("item_id", "date"), p.calendar(), "snap_TX")


@query("price_to_days", with_panel("""
SELECT c.date, c.wm_yr_wk, m.mean_price
FROM calendar c LEFT JOIN (
  SELECT wm_yr_wk, CAST(sum(CAST(round(sell_price * 100) AS BIGINT)) AS DOUBLE) / (count(*) * CAST(100 AS DOUBLE)) AS mean_price
  FROM prices GROUP BY wm_yr_wk) m USING (wm_yr_wk)"""))
def price_to_days(spark, sf_dir):
    """Weekly mean price over items fanned out to the days of the week.

    Prices are whole cents, so the mean is an integer cent sum divided once:
    exact in any summation order."""
    p = SalesPanel(spark, sf_dir)
    cents = F.round(F.col("sell_price") * 100).cast("bigint")
    mean_price = p.prices().groupBy("wm_yr_wk").agg(
        (F.sum(cents).cast("double") / (F.count("*") * F.lit(100.0))).alias("mean_price"))
    return p.calendar().select("date", "wm_yr_wk").join(mean_price, "wm_yr_wk", "left")


WEEKLY_CAL_SQL = """
weekly_cal AS (
  SELECT wm_yr_wk, count(event_name_1) + count(event_name_2) AS n_events,
         CAST(sum(snap_TX) AS BIGINT) AS snap_days
  FROM calendar GROUP BY wm_yr_wk)"""


def weekly_cal(p: SalesPanel):
    return p.calendar().groupBy("wm_yr_wk").agg(
        (F.count("event_name_1") + F.count("event_name_2")).alias("n_events"),
        F.sum("snap_TX").cast("bigint").alias("snap_days"))


@query("price_week_calendar", with_panel("""
SELECT p.item_id, p.wm_yr_wk, p.sell_price, w.n_events, w.snap_days FROM prices p JOIN weekly_cal w USING (wm_yr_wk)""",
                                         WEEKLY_CAL_SQL))
def price_week_calendar(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    return p.prices().select("item_id", "wm_yr_wk", "sell_price").join(checked_broadcast(weekly_cal(p)), "wm_yr_wk")
