"""Queries: exploration aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.functions import dates as D
from tillcast.operators import enrich, explore, features, score
from tillcast.operators.forecast import naive
from tillcast.plans.oracle import with_panel
from tillcast.plans.q_forecast import SNAIVE_CTES
from tillcast.plans.q_reshape import _ENRICHED, enriched
from tillcast.plans.registry import query
from tillcast.sources.panel import CALENDAR_EXTRA_DAYS, SalesPanel

WEEK_END_SQL = "CAST(date_trunc('week', date) + INTERVAL 6 DAY AS DATE)"


def _r6(df, *cols):
    for c in cols:
        df = df.withColumn(c, F.round(c, 6))
    return df


@query("first_dates", with_panel("""
SELECT item_id, min(CASE WHEN sell_price IS NOT NULL THEN date END) AS first_price_date,
       min(CASE WHEN sales_amount > 0 THEN date END) AS first_sale_date
FROM enriched WHERE date <= (SELECT hi - 28 FROM bounds) GROUP BY item_id""", _ENRICHED))
def first_dates(spark, sf_dir):
    """First priced and first sold day of each item in the training days."""
    p = SalesPanel(spark, sf_dir)
    e = enriched(p).filter(F.col("date") <= p.train_end())
    return e.groupBy("item_id").agg(
        F.min(F.when(F.col("sell_price").isNotNull(), F.col("date"))).alias("first_price_date"),
        F.min(F.when(F.col("sales_amount") > 0, F.col("date"))).alias("first_sale_date"))


@query("product_age", with_panel("""
SELECT item_id, CAST(date_diff('day', min(date), (SELECT hi + 28 FROM bounds)) AS INTEGER) AS product_age
FROM train WHERE sales_amount > 0 GROUP BY item_id"""))
def product_age(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    first = p.train().filter(F.col("sales_amount") > 0).groupBy("item_id").agg(F.min("date").alias("first_sale"))
    end = F.date_add(p.last_day(), CALENDAR_EXTRA_DAYS)  # calendar length minus the day number of the first sale
    return first.select("item_id", F.datediff(end, F.col("first_sale")).alias("product_age"))


@query("item_totals", with_panel(
    "SELECT item_id, sum(sales_amount) AS total FROM sales GROUP BY item_id ORDER BY total DESC"))
def item_totals(spark, sf_dir):
    s = SalesPanel(spark, sf_dir).sales()
    return s.groupBy("item_id").agg(F.sum("sales_amount").alias("total")).orderBy(F.col("total").desc())


@query("daily_totals", with_panel("SELECT date, sum(sales_amount) AS total FROM sales GROUP BY date"))
def daily_totals(spark, sf_dir):
    return SalesPanel(spark, sf_dir).sales().groupBy("date").agg(F.sum("sales_amount").alias("total"))


@query("items_sold_weekly", with_panel(f"""
SELECT {WEEK_END_SQL} AS date, CAST(sum(n) AS BIGINT) AS item_days_sold
FROM (SELECT date, CAST(sum(CAST(sales_amount > 0 AS INTEGER)) AS BIGINT) AS n FROM sales GROUP BY date)
GROUP BY 1"""))
def items_sold_weekly(spark, sf_dir):
    s = SalesPanel(spark, sf_dir).sales()
    daily = s.groupBy("date").agg(F.sum((F.col("sales_amount") > 0).cast("int")).alias("n"))
    return explore.resample(daily, "date", "week", [F.sum("n").cast("bigint").alias("item_days_sold")])


@query("weekly_sales", with_panel(f"SELECT {WEEK_END_SQL} AS date, sum(sales_amount) AS sales FROM sales GROUP BY 1"))
def weekly_sales(spark, sf_dir):
    s = SalesPanel(spark, sf_dir).sales()
    return explore.resample(s, "date", "week", [F.sum("sales_amount").alias("sales")])


_DAILY_PRICE = """
daily_price AS (SELECT c.date, m.mean_price FROM calendar c
  JOIN (SELECT wm_yr_wk, avg(sell_price) AS mean_price FROM prices GROUP BY wm_yr_wk) m USING (wm_yr_wk))"""


def daily_price(p):
    m = p.prices().groupBy("wm_yr_wk").agg(F.avg("sell_price").alias("mean_price"))
    return p.calendar().select("date", "wm_yr_wk").join(m, "wm_yr_wk").select("date", "mean_price")


@query("weekly_price", with_panel(
    f"SELECT {WEEK_END_SQL} AS date, round(avg(mean_price), 6) AS weekly_price FROM daily_price GROUP BY 1",
    _DAILY_PRICE))
def weekly_price(spark, sf_dir):
    d = daily_price(SalesPanel(spark, sf_dir))
    return _r6(explore.resample(d, "date", "week", [F.avg("mean_price").alias("weekly_price")]), "weekly_price")


@query("weekly_sales_by_item", with_panel(
    f"SELECT item_id, {WEEK_END_SQL} AS date, sum(sales_amount) AS sales FROM sales GROUP BY 1, 2"))
def weekly_sales_by_item(spark, sf_dir):
    s = SalesPanel(spark, sf_dir).sales()
    return explore.resample(s, "date", "week", [F.sum("sales_amount").alias("sales")], keys=["item_id"])


@query("weekly_calendar", with_panel(f"""
SELECT {WEEK_END_SQL} AS date, max(wm_yr_wk) AS wm_yr_wk, CAST(sum(ce) AS BIGINT) AS count_events,
       CAST(sum(CASE WHEN weekday NOT IN ('Saturday', 'Sunday') THEN ce ELSE 0 END) AS BIGINT) AS count_events_not_weekend,
       CAST(sum(CASE WHEN weekday IN ('Saturday', 'Sunday') THEN ce ELSE 0 END) AS BIGINT) AS count_events_not_weekday,
       round(avg(snap_TX), 6) AS snap_TX_mean, CAST(sum(snap_TX) AS BIGINT) AS snap_TX_sum
FROM (SELECT *, CAST(event_name_1 IS NOT NULL AS INTEGER) + CAST(event_name_2 IS NOT NULL AS INTEGER) AS ce FROM calendar)
GROUP BY 1"""))
def weekly_calendar(spark, sf_dir):
    cal = SalesPanel(spark, sf_dir).calendar_scan()
    ce = F.col("event_name_1").isNotNull().cast("int") + F.col("event_name_2").isNotNull().cast("int")
    wk = F.col("weekday").isin(features.WEEKEND_DAYS)
    c = cal.withColumn("ce", ce)
    out = explore.resample(c, "date", "week", [
        F.max("wm_yr_wk").alias("wm_yr_wk"),
        F.sum("ce").cast("bigint").alias("count_events"),
        F.sum(F.when(~wk, F.col("ce")).otherwise(0)).cast("bigint").alias("count_events_not_weekend"),
        F.sum(F.when(wk, F.col("ce")).otherwise(0)).cast("bigint").alias("count_events_not_weekday"),
        F.avg("snap_TX").alias("snap_TX_mean"),
        F.sum("snap_TX").cast("bigint").alias("snap_TX_sum")])
    return _r6(out, "snap_TX_mean")


@query("monthly_yearly_price", with_panel("""
SELECT 'month' AS period, last_day(date) AS date, round(avg(mean_price), 6) AS mean_price FROM daily_price GROUP BY 1, 2
UNION ALL
SELECT 'year', make_date(CAST(year(date) AS INTEGER), 12, 31), round(avg(mean_price), 6) FROM daily_price GROUP BY 1, 2""",
    _DAILY_PRICE))
def monthly_yearly_price(spark, sf_dir):
    d = daily_price(SalesPanel(spark, sf_dir))
    m = explore.resample(d, "date", "month", [F.avg("mean_price").alias("mean_price")])
    y = explore.resample(d, "date", "year", [F.avg("mean_price").alias("mean_price")])
    out = (m.select(F.lit("month").alias("period"), "date", "mean_price")
           .unionByName(y.select(F.lit("year").alias("period"), "date", "mean_price")))
    return _r6(out, "mean_price")


@query("events_by_day", with_panel("""
SELECT CAST(day(t.date) AS INTEGER) AS day, c.event_name_1, count(*) AS n
FROM train t JOIN calendar c USING (date) WHERE c.event_name_1 IS NOT NULL
GROUP BY 1, 2 ORDER BY n DESC, 1, 2"""))
def events_by_day(spark, sf_dir):
    """Training rows by day of month and event, most frequent first."""
    p = SalesPanel(spark, sf_dir)
    e = enrich.with_calendar(p.train(), p.calendar().filter(F.col("event_name_1").isNotNull()))
    counts = e.groupBy(F.dayofmonth("date").alias("day"), "event_name_1").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "day", "event_name_1")


@query("value_counts", with_panel(
    "SELECT item_id, count(*) AS n FROM prices GROUP BY item_id ORDER BY n DESC"))
def value_counts(spark, sf_dir):
    pr = SalesPanel(spark, sf_dir).prices()
    return pr.groupBy("item_id").agg(F.count("*").alias("n")).orderBy(F.col("n").desc())


@query("distinct_counts", with_panel("""
SELECT (SELECT count(DISTINCT item_id) FROM prices) AS n_items, (SELECT count(DISTINCT wm_yr_wk) FROM prices) AS n_weeks,
       (SELECT count(DISTINCT date) FROM calendar) AS n_dates, (SELECT count(DISTINCT event_name_1) FROM calendar) AS n_events,
       (SELECT count(DISTINCT sell_price) FROM prices) AS n_prices"""))
def distinct_counts(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    pr = p.prices().agg(F.countDistinct("item_id").alias("n_items"), F.countDistinct("wm_yr_wk").alias("n_weeks"),
                        F.countDistinct("sell_price").alias("n_prices"))
    cal = p.calendar().agg(F.countDistinct("date").alias("n_dates"), F.countDistinct("event_name_1").alias("n_events"))
    return pr.select("n_items", "n_weeks", cal.select("n_dates").scalar().alias("n_dates"),
                     cal.select("n_events").scalar().alias("n_events"), "n_prices")


@query("null_profile", with_panel("""
SELECT * FROM (
  SELECT 'sell_price' AS column, count(*) FILTER (WHERE sell_price IS NULL) AS n_null FROM enriched
  UNION ALL SELECT 'event_name_1', count(*) FILTER (WHERE event_name_1 IS NULL) FROM enriched
  UNION ALL SELECT 'event_type_1', count(*) FILTER (WHERE event_type_1 IS NULL) FROM enriched
  UNION ALL SELECT 'event_name_2', count(*) FILTER (WHERE event_name_2 IS NULL) FROM enriched
  UNION ALL SELECT 'event_type_2', count(*) FILTER (WHERE event_type_2 IS NULL) FROM enriched)
WHERE n_null > 0""", _ENRICHED))
def null_profile(spark, sf_dir):
    return explore.null_profile(enriched(SalesPanel(spark, sf_dir)))


@query("profile_numeric", with_panel("""
SELECT 'sell_price' AS column, count(sell_price) AS count, round(avg(sell_price), 6) AS mean,
       round(stddev_samp(sell_price), 6) AS std, min(sell_price) AS min,
       round(quantile_cont(sell_price, 0.25), 6) AS q25, round(quantile_cont(sell_price, 0.5), 6) AS q50,
       round(quantile_cont(sell_price, 0.75), 6) AS q75, max(sell_price) AS max FROM prices
UNION ALL
SELECT 'sales_amount', count(sales_amount), round(avg(sales_amount), 6), round(stddev_samp(sales_amount), 6),
       min(sales_amount), round(quantile_cont(sales_amount, 0.25), 6), round(quantile_cont(sales_amount, 0.5), 6),
       round(quantile_cont(sales_amount, 0.75), 6), max(sales_amount) FROM sales"""))
def profile_numeric(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    a = explore.describe(p.prices(), ["sell_price"])
    b = explore.describe(p.sales(), ["sales_amount"])
    return _r6(a.unionByName(b), "mean", "std", "q25", "q50", "q75")


_TYPES = {"item_id": "string", "date": "date", "sales_amount": "double", "wm_yr_wk": "int", "weekday": "string", "wday": "int",
          "month": "int", "year": "int", "d": "string", "event_name_1": "string", "event_type_1": "string",
          "event_name_2": "string", "event_type_2": "string", "snap_TX": "int", "sell_price": "double"}


@query("schema_profile", with_panel("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column, '{t}' AS type, count({c}) AS non_null FROM enriched" for c, t in _TYPES.items()) + ")",
    _ENRICHED.replace("enriched AS (", "enriched AS MATERIALIZED (")))
def schema_profile(spark, sf_dir):
    return explore.schema_profile(enriched(SalesPanel(spark, sf_dir)))


@query("chart_mean_by", with_panel("""
SELECT c.year, c.month, round(avg(s.sales_amount), 6) AS mean_sales
FROM sales s JOIN calendar c USING (date) GROUP BY 1, 2"""))
def chart_mean_by(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    j = enrich.with_calendar(p.sales(), p.calendar())
    return _r6(j.groupBy("year", "month").agg(F.avg("sales_amount").alias("mean_sales")), "mean_sales")


@query("weekday_week_sum", with_panel("""
SELECT c.weekday, c.wm_yr_wk, sum(s.sales_amount) AS sales FROM sales s JOIN calendar c USING (date) GROUP BY 1, 2"""))
def weekday_week_sum(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    j = enrich.with_calendar(p.sales(), p.calendar())
    return j.groupBy("weekday", "wm_yr_wk").agg(F.sum("sales_amount").alias("sales"))


@query("mean_ci", with_panel("""
SELECT weekday, round(avg(total), 6) AS mean,
       round(avg(total) - 1.96 * stddev_samp(total) / sqrt(count(total)), 6) AS ci_low,
       round(avg(total) + 1.96 * stddev_samp(total) / sqrt(count(total)), 6) AS ci_high, count(total) AS n
FROM (SELECT s.date, c.weekday, sum(s.sales_amount) AS total FROM sales s JOIN calendar c USING (date) GROUP BY 1, 2)
GROUP BY weekday"""))
def mean_ci(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    daily = (enrich.with_calendar(p.sales(), p.calendar())
             .groupBy("date", "weekday").agg(F.sum("sales_amount").alias("total")))
    return _r6(explore.mean_ci(daily, ["weekday"], "total"), "mean", "ci_low", "ci_high")


BOOTSTRAP = 200


@query("mean_ci_bootstrap", with_panel(f"""
SELECT weekday, round(any_value(mean), 6) AS mean, round(quantile_cont(m, 0.025), 6) AS ci_low, round(quantile_cont(m, 0.975), 6) AS ci_high, any_value(n) AS n
FROM (SELECT weekday, any_value(mean) AS mean, any_value(n) AS n, sum(w * total) / nullif(sum(w), 0) AS m
      FROM (SELECT d.*, b, len(list_filter({explore.poisson_one()!r}, lambda c: c <= ('0x' || md5('0|' || strftime(date, '%Y-%m-%d') || '|' || b)[1:13])::BIGINT / {float(1 << 52)!r})) AS w
            FROM (SELECT *, avg(total) OVER (PARTITION BY weekday) AS mean, count(*) OVER (PARTITION BY weekday) AS n FROM (
                    SELECT s.date, c.weekday, sum(s.sales_amount) AS total FROM sales s JOIN calendar c USING (date) GROUP BY 1, 2)) d,
                 range(1, {BOOTSTRAP + 1}) t(b))
      GROUP BY weekday, b)
GROUP BY weekday"""))
def mean_ci_bootstrap(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    daily = (enrich.with_calendar(p.sales(), p.calendar())
             .groupBy("date", "weekday").agg(F.sum("sales_amount").alias("total")))
    return _r6(explore.bootstrap_ci(daily, ["weekday"], "total", ["date"], BOOTSTRAP), "mean", "ci_low", "ci_high")


@query("count_histogram", with_panel("""
SELECT bin, round(lo + bin * step, 6) AS bin_low, round(lo + (bin + 1) * step, 6) AS bin_high, count(*) AS count
FROM (SELECT LEAST(CAST(floor((x - lo) / step) AS INTEGER), nb - 1) AS bin, lo, step
      FROM (SELECT CAST(n AS DOUBLE) AS x FROM (SELECT item_id, count(*) AS n FROM prices GROUP BY item_id)),
           (SELECT lo, nb, CASE WHEN hi > lo THEN (hi - lo) / nb ELSE 1.0 END AS step FROM (
              SELECT lo, hi, CASE WHEN hi - lo > 0 THEN CAST(greatest(ceil((hi - lo) / w), 1) AS INTEGER) ELSE 1 END AS nb
              FROM (SELECT lo, hi, CASE WHEN fd > 0 THEN least(fd, st) ELSE st END AS w FROM (
                SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / (log2(count(x)) + 1) AS st,
                       2 * (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) * pow(count(x), -1.0 / 3) AS fd
                FROM (SELECT CAST(count(*) AS DOUBLE) AS x FROM prices GROUP BY item_id))))))
GROUP BY 1, 2, 3"""))
def count_histogram(spark, sf_dir):
    per_item = SalesPanel(spark, sf_dir).prices().groupBy("item_id").agg(F.count("*").alias("n"))
    return _r6(explore.auto_histogram(per_item, "n"), "bin_low", "bin_high")


@query("price_quantiles", with_panel("""
SELECT q[1] AS q0, q[2] AS q25, q[3] AS q50, q[4] AS q75, q[5] AS q100
FROM (SELECT quantile_cont(coalesce(sell_price, 0.0), [0.0, 0.25, 0.5, 0.75, 1.0]) AS q FROM enriched
      WHERE date <= (SELECT hi - 28 FROM bounds))""", _ENRICHED))
def price_quantiles(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    e = features.fill_defaults(enriched(p)).filter(F.col("date") <= p.train_end())
    q = features.price_edges(e)
    return q.select(*[F.col("edges")[i].alias(n) for i, n in enumerate(["q0", "q25", "q50", "q75", "q100"])])


@query("pred_vs_actual", with_panel("""
SELECT date, 'predicted_sales' AS variable, round(avg(f.mean), 6) AS value FROM snaive f JOIN test t USING (item_id, date) GROUP BY 1
UNION ALL
SELECT date, 'sales_amount', round(avg(t.sales_amount), 6) FROM snaive f JOIN test t USING (item_id, date) GROUP BY 1""",
    SNAIVE_CTES))
def pred_vs_actual(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    a = score.align(naive.fc_snaive(p.train()), p.test())
    long = a.select("date", F.col("yhat").alias("predicted_sales"), F.col("y").alias("sales_amount")).unpivot(
        ["date"], ["predicted_sales", "sales_amount"], "variable", "value")
    return _r6(long.groupBy("date", "variable").agg(F.avg("value").alias("value")), "value")


def _acf_sql(series: str, max_lag: int) -> str:
    """Autocorrelation of ``series`` (CTE series: t consecutive, y) to ``max_lag`` with the Bartlett band."""
    return with_panel(f"""
SELECT k, round(acf, 6) AS acf,
       round(1.96 * sqrt(CASE WHEN k = 0 THEN 0.0 WHEN k = 1 THEN 1.0 / n
            ELSE (1 + 2 * coalesce(sum(CASE WHEN k >= 1 THEN acf * acf END)
                 OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n END), 6) AS band
FROM (
  SELECT a.k, sum(a.e * b.e) / (SELECT sum(e * e) FROM dev) AS acf, (SELECT count(*) FROM dev) AS n
  FROM (SELECT t, e, CAST(k AS INTEGER) AS k FROM dev, range(0, {max_lag + 1}) r(k)) a JOIN dev b ON b.t = a.t + a.k
  GROUP BY a.k)""", series + """,
dev AS MATERIALIZED (SELECT t, y - (SELECT avg(y) FROM series) AS e FROM series)""")


_WEEK_NO = "CAST(date_diff('day', DATE '1970-01-04', week_end) / 7 AS INTEGER) AS t"
_SALES_SERIES = f"""
series AS MATERIALIZED (SELECT {_WEEK_NO}, y FROM (SELECT {WEEK_END_SQL} AS week_end, sum(sales_amount) AS y FROM sales GROUP BY 1))"""
_SNAP_SERIES = f"""
series AS MATERIALIZED (SELECT {_WEEK_NO}, y FROM (SELECT {WEEK_END_SQL} AS week_end, CAST(sum(snap_TX) AS DOUBLE) AS y FROM calendar GROUP BY 1))"""
_PRICE_SERIES = _DAILY_PRICE + """,
series AS MATERIALIZED (SELECT CAST(year(date) * 12 + month(date) AS INTEGER) AS t, avg(mean_price) AS y FROM daily_price GROUP BY 1)"""


def _weekly_series(df, value):
    wk = explore.resample(df, "date", "week", [F.sum(value).cast("double").alias("y")])
    return wk.select((F.datediff("date", F.lit("1970-01-04").cast("date")) / 7).cast("int").alias("t"), "y")


def _monthly_price(p):
    return daily_price(p).groupBy((F.year("date") * 12 + F.month("date")).alias("t")).agg(F.avg("mean_price").alias("y"))


_ACF = {
    "acf_weekly": (_SALES_SERIES, 24, lambda p: _weekly_series(p.sales(), "sales_amount")),
    "acf_weekly_52": (_SALES_SERIES, 52, lambda p: _weekly_series(p.sales(), "sales_amount")),
    "acf_snap_weekly_52": (_SNAP_SERIES, 52, lambda p: _weekly_series(p.calendar_scan(), "snap_TX")),
    "acf_price_monthly_24": (_PRICE_SERIES, 24, _monthly_price),
}
for _name, (_series, _lag, _make) in _ACF.items():
    def _query(make, max_lag):
        return lambda spark, sf_dir: _r6(explore.acf(make(SalesPanel(spark, sf_dir)), "t", "y", max_lag), "acf", "band")

    query(_name, _acf_sql(_series, _lag))(_query(_make, _lag))
