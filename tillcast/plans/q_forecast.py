"""Queries: benchmark forecasts (F1-F4) and the horizon scaffold."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.operators.forecast import naive
from tillcast.plans.oracle import with_panel
from tillcast.plans.registry import query
from tillcast.sources.panel import SalesPanel

_LAST = "last AS (SELECT item_id, max(date) AS last_date, count(*) AS n, avg(sales_amount) AS y_mean FROM train GROUP BY item_id)"
_FIRST_LAST = """
ends AS (
  SELECT l.item_id, l.last_date, l.n, l.y_mean,
         (SELECT sales_amount FROM train t WHERE t.item_id = l.item_id AND t.date = l.last_date) AS y_last,
         (SELECT sales_amount FROM train t WHERE t.item_id = l.item_id
            AND t.date = (SELECT min(date) FROM train u WHERE u.item_id = l.item_id)) AS y_first
  FROM last l)"""
_GRID = "grid AS (SELECT e.*, h, CAST(last_date + h AS DATE) AS date FROM ends e, (SELECT CAST(range AS INTEGER) AS h FROM range(1, 29)) r)"


@query("horizon_grid", with_panel(
    "SELECT item_id, date, CAST(h AS INTEGER) AS h_step FROM grid",
    ",\n".join([_LAST, _FIRST_LAST, _GRID])))
def horizon_grid(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    last = p.train().groupBy("item_id").agg(F.max("date").alias("last_date"))
    return naive.horizon_grid(last, "item_id", 28).select("item_id", "date", "h_step")


@query("fc_mean", with_panel(
    "SELECT item_id, date, 'mean' AS model, round(y_mean, 6) AS mean FROM grid",
    ",\n".join([_LAST, _FIRST_LAST, _GRID])))
def fc_mean(spark, sf_dir):
    f = naive.fc_mean(SalesPanel(spark, sf_dir).train())
    return f.withColumn("mean", F.round("mean", 6))


@query("fc_naive", with_panel(
    "SELECT item_id, date, 'naive' AS model, y_last AS mean FROM grid",
    ",\n".join([_LAST, _FIRST_LAST, _GRID])))
def fc_naive(spark, sf_dir):
    return naive.fc_naive(SalesPanel(spark, sf_dir).train())


@query("fc_drift", with_panel(
    """SELECT item_id, date, 'drift' AS model,
         round(y_last + h * CASE WHEN n > 1 THEN (y_last - y_first) / (n - 1) ELSE 0 END, 6) AS mean
       FROM grid""",
    ",\n".join([_LAST, _FIRST_LAST, _GRID])))
def fc_drift(spark, sf_dir):
    f = naive.fc_drift(SalesPanel(spark, sf_dir).train())
    return f.withColumn("mean", F.round("mean", 6))


_SNAIVE = """snaive AS (
  SELECT g.item_id, g.date, 'snaive' AS model, t.sales_amount AS mean
  FROM (SELECT item_id, last_date, h, CAST(last_date + h AS DATE) AS date FROM last, (SELECT CAST(range AS INTEGER) AS h FROM range(1, 29)) r) g
  JOIN train t ON t.item_id = g.item_id AND t.date = CAST(g.last_date - 6 + CAST((g.h - 1) % 7 AS INTEGER) AS DATE))"""

SNAIVE_CTES = ",\n".join([_LAST, _SNAIVE])

FAMILY_CTES = ",\n".join([_LAST, _FIRST_LAST, _GRID, _SNAIVE, """family AS (
  SELECT item_id, date, 'mean' AS model, y_mean AS mean FROM grid
  UNION ALL SELECT item_id, date, 'naive', y_last FROM grid
  UNION ALL SELECT item_id, date, 'drift', y_last + h * CASE WHEN n > 1 THEN (y_last - y_first) / (n - 1) ELSE 0 END FROM grid
  UNION ALL SELECT * FROM snaive)""", """aligned AS (
  SELECT f.item_id, f.date, f.model, t.sales_amount AS y, f.mean AS yhat FROM family f JOIN test t USING (item_id, date))"""])


@query("fc_snaive", with_panel("SELECT * FROM snaive", SNAIVE_CTES))
def fc_snaive(spark, sf_dir):
    return naive.fc_snaive(SalesPanel(spark, sf_dir).train())
