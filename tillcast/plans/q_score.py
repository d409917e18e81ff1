"""Queries: scoring of forecasts against the held-out 28 days (M1-M9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.operators import score
from tillcast.operators.forecast import naive
from tillcast.plans.oracle import with_panel
from tillcast.plans.q_forecast import FAMILY_CTES, SNAIVE_CTES
from tillcast.plans.registry import query
from tillcast.sources.panel import SalesPanel


def _r6(df, *cols):
    for c in cols:
        df = df.withColumn(c, F.round(c, 6))
    return df


def snaive_aligned(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    return score.align(naive.fc_snaive(p.train()), p.test())


def family_aligned(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    return score.align(naive.naive_family(p.train()), p.test())


_ALIGNED = SNAIVE_CTES + """,
aligned AS (SELECT f.item_id, f.date, f.model, t.sales_amount AS y, f.mean AS yhat
            FROM snaive f JOIN test t ON t.item_id = f.item_id AND t.date = f.date)"""

_PER_ITEM = """
SELECT model, round(avg(rmse), 6) AS rmse, count(*) AS n_items
FROM (SELECT model, item_id, sqrt(avg((y - yhat) ^ 2)) AS rmse FROM aligned GROUP BY model, item_id)
GROUP BY model"""


@query("rmse_per_item_mean", with_panel(_PER_ITEM, _ALIGNED))
def rmse_per_item_mean(spark, sf_dir):
    return _r6(score.rmse_per_item_mean(snaive_aligned(spark, sf_dir)), "rmse")


@query("rmse_by_model", with_panel(_PER_ITEM, FAMILY_CTES))
def rmse_by_model(spark, sf_dir):
    return _r6(score.rmse_per_item_mean(family_aligned(spark, sf_dir)), "rmse")


_PER_DAY = """
SELECT model, round(avg(rmse_day), 6) AS rmse_per_day, count(*) AS n_days
FROM (SELECT model, date, sqrt(avg((y - yhat) ^ 2)) AS rmse_day FROM aligned GROUP BY model, date) GROUP BY model"""


@query("rmse_per_day_mean", with_panel(_PER_DAY, FAMILY_CTES))
def rmse_per_day_mean(spark, sf_dir):
    return _r6(score.rmse_per_day_mean(family_aligned(spark, sf_dir)), "rmse_per_day")


@query("pooled_errors", with_panel("""
SELECT model, round(avg(abs(y - yhat)), 6) AS mae, round(avg((y - yhat) ^ 2), 6) AS mse,
       round(sqrt(avg((y - yhat) ^ 2)), 6) AS rmse_pooled, count(*) AS n
FROM aligned GROUP BY model""", FAMILY_CTES))
def pooled_errors(spark, sf_dir):
    out = score.pooled_errors(family_aligned(spark, sf_dir)).select("model", "mae", "mse", "rmse_pooled", "n")
    return _r6(out, "mae", "mse", "rmse_pooled")


@query("mape", with_panel("""
SELECT model, round(big, 6) * (1.0 / 2.220446049250313e-16) / n + round(small, 6) / n AS mape FROM (
  SELECT model, sum(CASE WHEN abs(y) < 2.220446049250313e-16 THEN abs(y - yhat) ELSE 0.0 END) AS big,
         sum(CASE WHEN abs(y) >= 2.220446049250313e-16 THEN abs(y - yhat) / abs(y) ELSE 0.0 END) AS small, count(*) AS n
  FROM aligned GROUP BY model)""", FAMILY_CTES))
def mape(spark, sf_dir):
    sums = family_aligned(spark, sf_dir).groupBy("model").agg(*score.mape_parts())
    # values near 2^52: the sums are rounded here so that the order of summing does not show
    return sums.select("model", score.mape_value(F.round("_mape_big", 6), F.round("_mape_small", 6)).alias("mape"))


@query("wape", with_panel("""
SELECT model, round(sum(abs(y - yhat)) / sum(abs(y)), 6) AS wape FROM aligned GROUP BY model""", FAMILY_CTES))
def wape(spark, sf_dir):
    return _r6(score.pooled_errors(family_aligned(spark, sf_dir)).select("model", "wape"), "wape")


@query("poisson_deviance", with_panel("""
SELECT model, CASE WHEN count(*) FILTER (WHERE yhat <= 0) > 0 THEN NULL
  ELSE round(avg(2 * (CASE WHEN y > 0 THEN y * ln(y / yhat) ELSE 0 END - y + yhat)), 6) END AS poisson_deviance
FROM aligned GROUP BY model""", FAMILY_CTES))
def poisson_deviance(spark, sf_dir):
    out = score.pooled_errors(family_aligned(spark, sf_dir)).select("model", "poisson_deviance")
    return _r6(out, "poisson_deviance")


@query("leaderboard", with_panel("""
SELECT a.model, a.rmse, a.n_items, b.rmse_per_day, b.n_days, c.rmse_pooled, c.mae, c.n_absent
FROM (""" + _PER_ITEM.replace("aligned", "whole") + """) a JOIN (""" + _PER_DAY.replace("aligned", "whole") + """) b USING (model)
JOIN (SELECT model, round(sqrt(avg((y - yhat) ^ 2)), 6) AS rmse_pooled, round(avg(abs(y - yhat)), 6) AS mae,
             CAST(sum(absent) AS BIGINT) AS n_absent FROM whole GROUP BY model) c USING (model)
ORDER BY a.rmse""", FAMILY_CTES + """,
whole AS MATERIALIZED (SELECT m.model, t.item_id, t.date, t.sales_amount AS y, coalesce(f.mean, 0.0) AS yhat, CAST(f.mean IS NULL AS INTEGER) AS absent
  FROM (SELECT DISTINCT model FROM family) m CROSS JOIN test t
  LEFT JOIN family f ON f.model = m.model AND f.item_id = t.item_id AND f.date = t.date)"""))
def leaderboard(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    lb = score.leaderboard(naive.naive_family(p.train()), p.test())
    return _r6(lb, "rmse", "rmse_per_day", "rmse_pooled", "mae").select(
        "model", "rmse", "n_items", "rmse_per_day", "n_days", "rmse_pooled", "mae", "n_absent")


@query("negative_forecasts", with_panel("""
SELECT model, count(*) FILTER (WHERE all_neg) AS items_all_negative, CAST(sum(neg_rows) AS BIGINT) AS negative_rows
FROM (SELECT model, item_id, bool_and(mean < 0) AS all_neg, count(*) FILTER (WHERE mean < 0) AS neg_rows
      FROM family GROUP BY model, item_id) GROUP BY model""", FAMILY_CTES))
def negative_forecasts(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    return score.negative_forecasts(naive.naive_family(p.train()))


@query("rmse_rounded", with_panel("""
SELECT model, round(avg(rmse), 6) AS rmse, count(*) AS n_items
FROM (SELECT model, item_id, sqrt(avg((y - round_even(yhat, 0)) ^ 2)) AS rmse FROM aligned GROUP BY model, item_id)
GROUP BY model""", FAMILY_CTES))
def rmse_rounded(spark, sf_dir):
    a = family_aligned(spark, sf_dir).withColumn("yhat", F.bround("yhat", 0))
    return _r6(score.rmse_per_item_mean(a), "rmse")
