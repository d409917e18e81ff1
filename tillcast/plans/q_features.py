"""Queries: feature pipeline A and its window operators (W1-W12, P12, pipeline A)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillcast.operators import features
from tillcast.plans.oracle import with_panel
from tillcast.plans.q_reshape import _ENRICHED, enriched
from tillcast.plans.registry import query
from tillcast.sources.panel import SalesPanel


def feature_table(p: SalesPanel, **kw):
    return features.build_features(p.sales(), p.calendar(), p.prices(), p.train_end(), **kw)


_W = "PARTITION BY item_id ORDER BY date"
_WA = "PARTITION BY item_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"


def _lag_sql(c):
    return (f"CASE WHEN row_number() OVER ({_W}) <= 7 THEN first_value({c}) OVER ({_WA}) "
            f"ELSE lag({c}, 7) OVER ({_W}) END AS lag7_{c}")


def _pct_sql(name, key_expr):
    return f"""
{name}_m AS (SELECT item_id, {key_expr} AS k, avg(sell_price) AS m FROM banded GROUP BY ALL),
{name}_c AS MATERIALIZED (SELECT item_id, k, coalesce(CASE WHEN pm = 0 THEN NULL ELSE (m - pm) / pm END, 0) * 100 AS {name}
             FROM (SELECT *, lag(m) OVER (PARTITION BY item_id ORDER BY k) AS pm FROM {name}_m))"""


FEATURE_CTES = _ENRICHED + """,
flagged AS MATERIALIZED (
  SELECT e.*, CASE WHEN date = min(CASE WHEN sell_price IS NOT NULL AND date <= (SELECT hi - 28 FROM bounds) THEN date END)
                     OVER (PARTITION BY item_id) THEN 1 ELSE 0 END AS week_added
  FROM enriched e),
filled AS (
  SELECT item_id, date, sales_amount, wm_yr_wk, weekday, wday, year, d, snap_TX, week_added,
         coalesce(event_name_1, 'No event') AS event_name_1, coalesce(event_type_1, 'No event type') AS event_type_1,
         coalesce(event_name_2, 'No event') AS event_name_2, coalesce(event_type_2, 'No event type') AS event_type_2,
         coalesce(sell_price, 0.0) AS sell_price
  FROM flagged),
edges AS (SELECT quantile_cont(sell_price, [0.0, 0.25, 0.5, 0.75, 1.0]) AS q FROM filled
          WHERE date <= (SELECT hi - 28 FROM bounds)),
banded AS MATERIALIZED (
  SELECT f.*, CASE WHEN sell_price > q[1] AND sell_price <= q[2] THEN 'low'
                   WHEN sell_price > q[2] AND sell_price <= q[3] THEN 'mid-low'
                   WHEN sell_price > q[3] AND sell_price <= q[4] THEN 'mid-high'
                   WHEN sell_price > q[4] AND sell_price <= q[5] THEN 'high' ELSE 'low' END AS price_category
  FROM filled f, edges),
lagged AS MATERIALIZED (
  SELECT b.*, date_trunc('month', date) AS mk, date_trunc('quarter', date) AS qk, date_trunc('year', date) AS yk,
  """ + ",\n  ".join(_lag_sql(c) for c in features.LAG7_COLUMNS) + """
  FROM banded b),""" + ",".join([
    _pct_sql("weekly_pct_change", "wm_yr_wk"),
    _pct_sql("monthly_pct_change", "date_trunc('month', date)"),
    _pct_sql("qrt_pct_change", "date_trunc('quarter', date)"),
    _pct_sql("yearly_pct_change", "date_trunc('year', date)"),
]) + """,
j1 AS MATERIALIZED (SELECT l.*, w.weekly_pct_change FROM lagged l
  JOIN weekly_pct_change_c w ON w.item_id = l.item_id AND w.k = l.wm_yr_wk),
j2 AS MATERIALIZED (SELECT l.*, m.monthly_pct_change FROM j1 l
  JOIN monthly_pct_change_c m ON m.item_id = l.item_id AND m.k = l.mk),
j3 AS MATERIALIZED (SELECT l.*, q.qrt_pct_change FROM j2 l
  JOIN qrt_pct_change_c q ON q.item_id = l.item_id AND q.k = l.qk),
j4 AS MATERIALIZED (SELECT l.*, y.yearly_pct_change FROM j3 l
  JOIN yearly_pct_change_c y ON y.item_id = l.item_id AND y.k = l.yk),
features AS (
  SELECT l.* EXCLUDE (mk, qk, yk),
         weekday NOT IN ('Saturday', 'Sunday') AS is_weekday, weekday IN ('Saturday', 'Sunday') AS is_weekend,
         CAST(event_name_1 <> 'No event' AS INTEGER) + CAST(event_name_2 <> 'No event' AS INTEGER) AS is_holiday,
         CAST(day(date) AS INTEGER) AS day, CAST(quarter(date) AS INTEGER) AS quarter,
         CAST(month(date) AS INTEGER) AS month, CAST(week(date) AS INTEGER) AS week
  FROM j4 l)"""

PCT = ["weekly_pct_change", "monthly_pct_change", "qrt_pct_change", "yearly_pct_change"]


@query("feature_table", with_panel(
    "SELECT * REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in PCT) + ") FROM features", FEATURE_CTES))
def q_feature_table(spark, sf_dir):
    f = feature_table(SalesPanel(spark, sf_dir))
    for c in PCT:
        f = f.withColumn(c, F.round(c, 6))
    return f


@query("lag7_features", with_panel(
    "SELECT item_id, date, " + ", ".join(f"lag7_{c}" for c in features.LAG7_COLUMNS) + " FROM features",
    FEATURE_CTES))
def lag7_features(spark, sf_dir):
    return feature_table(SalesPanel(spark, sf_dir)).select("item_id", "date", *[f"lag7_{c}" for c in features.LAG7_COLUMNS])


for _name, _col in [("pct_change_week", "weekly_pct_change"), ("pct_change_month", "monthly_pct_change"),
                    ("pct_change_quarter", "qrt_pct_change"), ("pct_change_year", "yearly_pct_change")]:
    def _mk(col):
        def fn(spark, sf_dir):
            p = SalesPanel(spark, sf_dir)
            e = features.fill_defaults(enriched(p))
            period = {"weekly_pct_change": "week", "monthly_pct_change": "month",
                      "qrt_pct_change": "quarter", "yearly_pct_change": "year"}[col]
            pc = features.pct_change("sell_price", period)
            return e.select("item_id", "date", F.round(pc, 6).alias(col))
        return fn

    query(_name, with_panel(f"SELECT item_id, date, round({_col}, 6) AS {_col} FROM features", FEATURE_CTES))(_mk(_col))


@query("price_band", with_panel(
    "SELECT item_id, date, sell_price, price_category FROM features", FEATURE_CTES))
def price_band(spark, sf_dir):
    return feature_table(SalesPanel(spark, sf_dir)).select("item_id", "date", "sell_price", "price_category")


_FFILL = _ENRICHED + """,
ff AS (SELECT item_id, date, sell_price,
         last_value(sell_price IGNORE NULLS) OVER (PARTITION BY item_id ORDER BY date
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price_ffill
       FROM enriched WHERE date <= (SELECT hi - 28 FROM bounds))"""


def ffilled(p: SalesPanel):
    e = enriched(p).filter(F.col("date") <= p.train_end())
    return e.select("item_id", "date", "sell_price", features.forward_fill("sell_price").alias("price_ffill"))


@query("ffill_price", with_panel("SELECT item_id, date, price_ffill FROM ff", _FFILL))
def ffill_price(spark, sf_dir):
    return ffilled(SalesPanel(spark, sf_dir)).select("item_id", "date", "price_ffill")


@query("bfill", with_panel("""
SELECT item_id, date, first_value(sell_price IGNORE NULLS) OVER (PARTITION BY item_id ORDER BY date
         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS price_bfill
FROM enriched""", _ENRICHED))
def bfill(spark, sf_dir):
    e = enriched(SalesPanel(spark, sf_dir))
    return e.select("item_id", "date", features.back_fill("sell_price").alias("price_bfill"))


@query("price_lag7", with_panel("""
SELECT item_id, date, CASE WHEN row_number() OVER (PARTITION BY item_id ORDER BY date) <= 7
         THEN first_value(price_ffill) OVER (PARTITION BY item_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
         ELSE lag(price_ffill, 7) OVER (PARTITION BY item_id ORDER BY date) END AS sell_price_lag_7
FROM ff""", _FFILL))
def price_lag7(spark, sf_dir):
    f = ffilled(SalesPanel(spark, sf_dir))
    return f.select("item_id", "date", features.lag_first_filled("price_ffill", 7).alias("sell_price_lag_7"))


@query("last_price", with_panel(
    "SELECT item_id, arg_max(price_ffill, date) AS last_price FROM ff GROUP BY item_id", _FFILL))
def last_price(spark, sf_dir):
    f = ffilled(SalesPanel(spark, sf_dir))
    return f.groupBy("item_id").agg(F.max_by("price_ffill", "date").alias("last_price"))


@query("nth_from_last", with_panel("""
SELECT item_id, date, price_ffill FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY date DESC) AS rn FROM ff) WHERE rn = 9""", _FFILL))
def nth_from_last(spark, sf_dir):
    f = ffilled(SalesPanel(spark, sf_dir))
    rn = F.row_number().over(Window.partitionBy("item_id").orderBy(F.col("date").desc()))
    return f.withColumn("rn", rn).filter(F.col("rn") == 9).select("item_id", "date", "price_ffill")


@query("sorted_output", with_panel("SELECT item_id, date, sales_amount FROM sales ORDER BY item_id, date"))
def sorted_output(spark, sf_dir):
    return SalesPanel(spark, sf_dir).sales().orderBy("item_id", "date")


@query("top_items", with_panel("""
SELECT item_id, sum(sales_amount) AS total FROM sales GROUP BY item_id ORDER BY total DESC, item_id LIMIT 10"""))
def top_items(spark, sf_dir):
    s = SalesPanel(spark, sf_dir).sales()
    return (s.groupBy("item_id").agg(F.sum("sales_amount").alias("total"))
            .orderBy(F.col("total").desc(), "item_id").limit(10))
