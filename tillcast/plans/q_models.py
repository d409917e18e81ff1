"""Queries: per-series statistical models (F5-F13) and their building blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.operators import reshape
from tillcast.operators.forecast import ar, decomposable, dynreg, ets, gram, naive, regarima, regressors, sarima, smoothing
from tillcast.plans.oracle import with_panel
from tillcast.plans.q_features import _FFILL
from tillcast.plans.q_forecast import FAMILY_CTES
from tillcast.plans.q_reshape import _pivot_sql
from tillcast.plans.registry import query
from tillcast.sources.panel import FIXED_DATE_EVENTS, SUNDAY_SECOND_EVENT, THANKSGIVING, SalesPanel


def train_reg(p: SalesPanel):
    return regressors.train_regressors(p.sales(), p.calendar(), p.prices(), p.train_end())


def future_reg(p: SalesPanel, tr=None):
    return regressors.future_regressors(tr if tr is not None else train_reg(p), p.calendar(), p.horizon)


_CALREG = """
calreg AS (
  SELECT date, wday, month, CAST(day(date) AS INTEGER) AS day_of_month, snap_TX, event,
    coalesce(lag(event, 1) OVER w, first_value(event) OVER wa) AS event_lag1,
    coalesce(lead(event, 1) OVER w, last_value(event) OVER wa) AS event_lead1,
    coalesce(lead(event, 2) OVER w, last_value(event) OVER wa) AS event_lead2,
    coalesce(lead(event, 3) OVER w, last_value(event) OVER wa) AS event_lead3
  FROM (SELECT *, CASE WHEN event_name_1 IS NOT NULL THEN 1 ELSE 0 END AS event FROM calendar)
  WINDOW w AS (ORDER BY date), wa AS (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"""

_FUTURE = _FFILL + "," + _CALREG + """,
tailp AS (SELECT item_id, date, coalesce(price_ffill, 0.0) AS sell_price,
                 row_number() OVER (PARTITION BY item_id ORDER BY date DESC) AS rn FROM ff),
lastp AS (SELECT item_id, max(date) AS last_date, arg_max(sell_price, date) AS last_price,
                 max(CASE WHEN rn = 9 THEN sell_price END) AS lag_price FROM tailp WHERE rn <= 9 GROUP BY item_id),
fgrid AS (SELECT item_id, last_price, lag_price, CAST(last_date + h AS DATE) AS date
          FROM lastp, (SELECT CAST(range AS INTEGER) AS h FROM range(1, 29)) r)"""


@query("future_regressors", with_panel("""
SELECT g.item_id, g.date, g.last_price AS sell_price, c.snap_TX, c.wday, c.month, c.day_of_month, c.event,
       g.lag_price AS sell_price_lag_7, c.event_lag1, c.event_lead1, c.event_lead2, c.event_lead3
FROM fgrid g JOIN calreg c USING (date)""", _FUTURE))
def future_regressors(spark, sf_dir):
    return future_reg(SalesPanel(spark, sf_dir))


@query("submissions_by_model", with_panel(_pivot_sql("family", "model, id"), FAMILY_CTES))
def submissions_by_model(spark, sf_dir):
    """All models' forecasts pivoted once, keyed by (model, id)."""
    p = SalesPanel(spark, sf_dir)
    fc = naive.naive_family(p.train())
    long = (fc.join(p.items(), "item_id")
            .withColumn("d", reshape.day_label("date", p.first_day()))
            .withColumn("mean", F.bround("mean", 0)))
    return long.groupBy("model", "id").pivot("d", p.test_labels()).agg(F.avg("mean"))


_TREG = _FFILL + "," + _CALREG + """,
treg AS (SELECT f.item_id, f.date, s.sales_amount AS y, coalesce(f.price_ffill, 0.0) AS sell_price, c.snap_TX
         FROM ff f JOIN train s USING (item_id, date) JOIN calreg c USING (date))"""


@query("dynreg_ols", with_panel("""
SELECT item_id, round(regr_intercept(y, snap_TX), 6) AS intercept, round(regr_slope(y, snap_TX), 6) AS slope
FROM treg GROUP BY item_id""", _TREG))
def dynreg_ols(spark, sf_dir):
    """One-regressor least squares per item through the Gram solver."""
    tr = train_reg(SalesPanel(spark, sf_dir))
    coef = gram.ols(gram.gram_sums(tr, "item_id", ["snap_TX"], "y"), "item_id", 2)
    return coef.select("item_id", F.round(F.col("beta")[0], 6).alias("intercept"),
                       F.round(F.col("beta")[1], 6).alias("slope"))


@query("gram_ar", with_panel("""
SELECT item_id,
  [sum(1.0), sum(l1), sum(l2), sum(l3), sum(ls), sum(l1 * l1), sum(l1 * l2), sum(l1 * l3), sum(l1 * ls),
   sum(l2 * l2), sum(l2 * l3), sum(l2 * ls), sum(l3 * l3), sum(l3 * ls), sum(ls * ls)] AS xtx,
  [sum(y), sum(l1 * y), sum(l2 * y), sum(l3 * y), sum(ls * y)] AS xty, sum(y * y) AS yty, count(*) AS n
FROM (SELECT item_id, sales_amount AS y,
        lag(sales_amount, 1) OVER w AS l1, lag(sales_amount, 2) OVER w AS l2, lag(sales_amount, 3) OVER w AS l3,
        lag(sales_amount, 7) OVER w AS ls
      FROM train WINDOW w AS (PARTITION BY item_id ORDER BY date))
WHERE ls IS NOT NULL GROUP BY item_id"""))
def gram_ar(spark, sf_dir):
    """The per-item sums every AR candidate is solved from."""
    tr = SalesPanel(spark, sf_dir).train()
    lg = ar.lagged(tr, "item_id", "date", "sales_amount", 3, 7)
    return gram.gram_sums(lg.filter(F.col("_ls").isNotNull()), "item_id", ["_l1", "_l2", "_l3", "_ls"], "y")


@query("fc_ar")
def fc_ar(spark, sf_dir):
    return ar.fc_ar(SalesPanel(spark, sf_dir).train())


@query("fc_arma")
def fc_arma(spark, sf_dir):
    """Moving-average terms by two Gram aggregations, no differences."""
    return ar.fc_arima(SalesPanel(spark, sf_dir).train(), name="arma")


@query("fc_arima")
def fc_arima(spark, sf_dir):
    """Differences, orders and coefficients chosen per series, by exact likelihood."""
    return sarima.fc_arima(SalesPanel(spark, sf_dir).train())


def _dynreg_query(name, xcols):
    def fn(spark, sf_dir):
        p = SalesPanel(spark, sf_dir)
        tr = train_reg(p)
        return regarima.fc_regarima(tr, future_reg(p, tr), xcols, name)
    return fn


@query("fc_dynreg_ar1")
def fc_dynreg_ar1(spark, sf_dir):
    """Calendar regression by Gram sums with an AR(1) error, no choice of orders."""
    p = SalesPanel(spark, sf_dir)
    tr = train_reg(p)
    return dynreg.fc_dynreg(tr, future_reg(p, tr), regressors.BASE_X, "dynreg_ar1")


query("fc_dynreg_snap")(_dynreg_query("dynreg_snap", ["snap_TX"]))
query("fc_dynreg_calendar")(_dynreg_query("dynreg_calendar", regressors.BASE_X))
query("fc_dynreg_lags")(_dynreg_query("dynreg_lags", regressors.BASE_X + regressors.LAG_X))
query("fc_dynreg_leads")(_dynreg_query("dynreg_leads", ["sell_price", "snap_TX", "event_lead1", "event_lead2",
                                                        "event_lead3"]))


def _design_sql():
    import math
    cols = ["round(days / 365.25, 6) AS t"]
    for j in range(1, decomposable.N_CHANGEPOINTS + 1):
        cols.append(f"round(greatest(days - span * {decomposable.CHANGEPOINT_RANGE} * {j} / "
                    f"{decomposable.N_CHANGEPOINTS + 1}, 0.0) / 365.25, 6) AS cp{j}")
    for k in range(1, decomposable.YEARLY_ORDER + 1):
        cols += [f"round(sin({2 * math.pi * k!r} * days / 365.25), 6) AS sin_y{k}",
                 f"round(cos({2 * math.pi * k!r} * days / 365.25), 6) AS cos_y{k}"]
    for k in range(1, decomposable.WEEKLY_ORDER + 1):
        cols += [f"round(sin({2 * math.pi * k!r} * days / 7.0), 6) AS sin_w{k}",
                 f"round(cos({2 * math.pi * k!r} * days / 7.0), 6) AS cos_w{k}"]
    for h in sorted([e[2] for e in FIXED_DATE_EVENTS] + [THANKSGIVING[0], SUNDAY_SECOND_EVENT[0]]):
        cols.append(f"CAST(coalesce(event_name_1 = '{h}' OR event_name_2 = '{h}', false) AS INTEGER) AS hol_{h}")
    return ("SELECT date, " + ", ".join(cols) + """
FROM (SELECT c.*, CAST(date_diff('day', b.lo, c.date) AS DOUBLE) AS days,
             CAST(date_diff('day', b.lo, b.hi - 28) AS DOUBLE) AS span FROM calendar c, bounds b)""")


@query("fourier_holiday_design", with_panel(_design_sql()))
def fourier_holiday_design(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    d = decomposable.design(p.calendar_scan(), p.first_day(), p.train_end())
    for c in d.columns:
        if c != "date" and not c.startswith("hol_"):
            d = d.withColumn(c, F.round(c, 6))
    return d


@query("fc_decomposable")
def fc_decomposable(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    return decomposable.fc_decomposable(p.train(), p.calendar(), p.first_day(), p.train_end(), p.horizon)


def _ses_sql() -> str:
    """Simple exponential smoothing over the whole training series of every
    item: the same left fold (level, SSE of one-step errors) per grid alpha
    as ``smoothing.fit``, the lowest AICc (k = 2) per item, a flat forecast."""
    alphas = ", ".join(repr(a) for a in smoothing.ALPHAS)
    return with_panel(f"""
SELECT item_id, CAST(last_date + step AS DATE) AS date, 'ses' AS model,
       l + step * 0.0 + 0.0 AS mean
FROM ses_best, (SELECT CAST(unnest(generate_series(1, 28)) AS INTEGER) AS step)
""", f"""
ses_series AS (
  SELECT item_id, max(date) AS last_date, CAST(count(*) AS DOUBLE) AS n,
         list(CAST(sales_amount AS DOUBLE) ORDER BY date) AS ys
  FROM train GROUP BY item_id),
ses_fit AS (
  SELECT item_id, last_date, n,
    list_reduce(ys, lambda acc, v: {{'l': alpha * v + (1 - alpha) * acc.l,
                                    'sse': acc.sse + (v - acc.l) * (v - acc.l)}},
                {{'l': ys[1], 'sse': CAST(0.0 AS DOUBLE)}}) AS st
  FROM ses_series, (SELECT unnest([{alphas}]::DOUBLE[]) AS alpha)),
ses_best AS (
  SELECT item_id, last_date,
    arg_min(st.l, n * ln(greatest(st.sse, 1e-12) / n) + 2 * 2 + 2 * 2 * 3 / (n - 2 - 1)) AS l
  FROM ses_fit GROUP BY item_id, last_date)
""")


@query("fc_ses", _ses_sql())
def fc_ses(spark, sf_dir):
    return smoothing.fc_ses(SalesPanel(spark, sf_dir).train())


@query("fc_ets_grid")
def fc_ets_grid(spark, sf_dir):
    """Additive forms over a grid of settings."""
    return smoothing.fc_ets_grouped(SalesPanel(spark, sf_dir).train())


@query("fc_holt_winters")
def fc_holt_winters(spark, sf_dir):
    """Error, trend, season and damping chosen per series."""
    return ets.fc_ets(SalesPanel(spark, sf_dir).train())
