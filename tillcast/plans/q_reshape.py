"""Queries: reshape, id and date functions, filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.functions import dates as D
from tillcast.operators import enrich, features, reshape, score
from tillcast.operators.forecast import naive
from tillcast.plans.oracle import with_panel
from tillcast.plans.q_forecast import SNAIVE_CTES
from tillcast.plans.registry import query
from tillcast.sources.panel import SalesPanel
from tillcast.session import checked_broadcast

ITEM_PATTERN = r"^[A-Z]+_[0-9]+"


def sales_wide(p: SalesPanel):
    """Actuals of the whole history as a wide table: id, one d_N column for each day (the sales file)."""
    long = (p.sales().join(p.items(), "item_id")
            .withColumn("d", reshape.day_label("date", p.first_day())))
    return reshape.pivot_wide(long, "id", "d", "sales_amount", p.day_labels())


_SALES_LONG = "SELECT i.id, 'd_' || CAST(date_diff('day', b.lo, t.date) + 1 AS VARCHAR) AS d, t.sales_amount AS sales FROM sales t JOIN items i USING (item_id), bounds b"
# The held-out days of the driver tables: they start at the same date at every scale.
_TEST_DAYS = range(2472, 2500)


def _pivot_sql(source: str, keys: str) -> str:
    """Wide submission with one column for each held-out day."""
    cols = ", ".join(f"avg(CASE WHEN n = {k} THEN mean END) AS d_{k}" for k in _TEST_DAYS)
    return f"""
SELECT {keys}, {cols}
FROM (SELECT f.model, i.id, CAST(date_diff('day', b.lo, f.date) + 1 AS INTEGER) AS n, round_even(f.mean, 0) AS mean
      FROM {source} f JOIN items i USING (item_id), bounds b)
GROUP BY {keys}"""


@query("melt_sales", with_panel(_SALES_LONG))
def melt_sales(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    return reshape.melt(sales_wide(p), ["id"], prefix="d_", var_name="d", value_name="sales")


@query("day_to_date", with_panel("SELECT item_id, date, sales_amount AS sales FROM sales"))
def day_to_date(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    long = reshape.melt(sales_wide(p), ["id"], prefix="d_", var_name="d", value_name="sales")
    return long.select(reshape.split_id("id")[0], reshape.day_label_to_date("d", p.first_day()).alias("date"), "sales")


@query("pivot_submission", with_panel(_pivot_sql("snaive", "id"), SNAIVE_CTES))
def pivot_submission(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    fc = naive.fc_snaive(p.train())
    long = (fc.join(p.items(), "item_id")
            .withColumn("d", reshape.day_label("date", p.first_day()))
            .withColumn("mean", F.bround("mean", 0)))
    return reshape.pivot_wide(long, "id", "d", "mean", p.test_labels())


@query("melt_compare", with_panel("""
SELECT f.item_id, f.date, 'predicted_sales' AS variable, f.mean AS value FROM snaive f JOIN test t USING (item_id, date)
UNION ALL
SELECT f.item_id, f.date, 'sales_amount' AS variable, t.sales_amount AS value FROM snaive f JOIN test t USING (item_id, date)
""", SNAIVE_CTES))
def melt_compare(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    a = score.align(naive.fc_snaive(p.train()), p.test())
    a = a.select("item_id", "date", F.col("yhat").alias("predicted_sales"), F.col("y").alias("sales_amount"))
    return a.unpivot(["item_id", "date"], ["predicted_sales", "sales_amount"], "variable", "value")


@query("concat_train_test", with_panel("SELECT * FROM train UNION ALL SELECT * FROM test"))
def concat_train_test(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    return reshape.concat_checked(p.train(), p.test())


@query("project_rename", with_panel("""
SELECT s.item_id AS product_id, s.date AS Date, s.sales_amount AS Sales, c.wday, c.month, c.snap_TX,
       CAST(day(s.date) AS INTEGER) AS day_of_month
FROM sales s JOIN calendar c USING (date)"""))
def project_rename(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    j = enrich.with_calendar(p.sales(), p.calendar())
    return (j.withColumnRenamed("item_id", "product_id").withColumnRenamed("date", "Date")
            .withColumnRenamed("sales_amount", "Sales")
            .withColumn("day_of_month", F.dayofmonth("Date"))
            .select("product_id", "Date", "Sales", "wday", "month", "snap_TX", "day_of_month"))


@query("split_id", with_panel("""
SELECT id, regexp_extract(id, '^(.*)_([^_]+)_([^_]+)_([^_]+)$', 1) AS item_id,
       regexp_extract(id, '^(.*)_([^_]+)_([^_]+)_([^_]+)$', 2) AS loc1,
       regexp_extract(id, '^(.*)_([^_]+)_([^_]+)_([^_]+)$', 3) AS loc2,
       regexp_extract(id, '^(.*)_([^_]+)_([^_]+)_([^_]+)$', 4) AS type
FROM items"""))
def split_id(spark, sf_dir):
    return SalesPanel(spark, sf_dir).items().select("id", *reshape.split_id("id"))


@query("extract_item", with_panel(
    "SELECT id, nullif(regexp_extract(id, '^[A-Z]+_[0-9]+', 0), '') AS item_code FROM items"))
def extract_item(spark, sf_dir):
    return SalesPanel(spark, sf_dir).items().select("id", reshape.extract_item("id", ITEM_PATTERN).alias("item_code"))


@query("parse_dates", with_panel("""
SELECT date, strftime(date, '%-m/%-d/%Y') AS date_text,
       CAST(strptime(strftime(date, '%-m/%-d/%Y'), '%m/%d/%Y') AS DATE) AS parsed,
       CAST(CAST(date AS VARCHAR) AS DATE) AS parsed_iso
FROM calendar"""))
def parse_dates(spark, sf_dir):
    cal = SalesPanel(spark, sf_dir).calendar_scan()
    t = F.date_format("date", "M/d/yyyy")
    return cal.select("date", t.alias("date_text"), D.parse_mdy(t).alias("parsed"),
                      D.parse_iso(F.col("date").cast("string")).alias("parsed_iso"))


@query("rebuild_date", with_panel(
    "SELECT date, make_date(year, month, CAST(day(date) AS INTEGER)) AS rebuilt FROM calendar"))
def rebuild_date(spark, sf_dir):
    cal = SalesPanel(spark, sf_dir).calendar_scan()
    return cal.select("date", F.make_date("year", "month", F.dayofmonth("date")).alias("rebuilt"))


@query("date_parts", with_panel("""
SELECT date, CAST(day(date) AS INTEGER) AS day, CAST(month(date) AS INTEGER) AS month,
       CAST(quarter(date) AS INTEGER) AS quarter, CAST(week(date) AS INTEGER) AS iso_week,
       CAST(isodow(date) - 1 AS INTEGER) AS weekday_no, CAST(year(date) AS INTEGER) AS year
FROM calendar"""))
def date_parts(spark, sf_dir):
    cal = SalesPanel(spark, sf_dir).calendar_scan()
    return cal.select("date", *D.date_parts("date"))


@query("weekend_flags", with_panel("""
SELECT date, weekday NOT IN ('Saturday', 'Sunday') AS is_weekday, weekday IN ('Saturday', 'Sunday') AS is_weekend,
       CAST(wday <= 2 AS INTEGER) AS weekend_by_wday
FROM calendar"""))
def weekend_flags(spark, sf_dir):
    cal = SalesPanel(spark, sf_dir).calendar_scan()
    wk = F.col("weekday").isin(features.WEEKEND_DAYS)
    return cal.select("date", (~wk).alias("is_weekday"), wk.alias("is_weekend"),
                      (F.col("wday") <= 2).cast("int").alias("weekend_by_wday"))


@query("holiday_count", with_panel("""
SELECT date, CAST(event_name_1 IS NOT NULL AS INTEGER) + CAST(event_name_2 IS NOT NULL AS INTEGER) AS is_holiday
FROM calendar"""))
def holiday_count(spark, sf_dir):
    cal = SalesPanel(spark, sf_dir).calendar_scan()
    return cal.select("date", (F.col("event_name_1").isNotNull().cast("int")
                               + F.col("event_name_2").isNotNull().cast("int")).alias("is_holiday"))


@query("event_flag", with_panel(
    "SELECT date, CASE WHEN event_name_1 IS NOT NULL THEN 1 ELSE 0 END AS event FROM calendar"))
def event_flag(spark, sf_dir):
    cal = SalesPanel(spark, sf_dir).calendar_scan()
    return cal.select("date", F.when(F.col("event_name_1").isNotNull(), 1).otherwise(0).alias("event"))


@query("day_after_event", with_panel("""
SELECT c.date, CASE WHEN a.date IS NULL THEN 0 ELSE 1 END AS after_thanksgiving
FROM calendar c LEFT JOIN (SELECT DISTINCT CAST(date + 1 AS DATE) AS date FROM calendar WHERE event_name_1 = 'Thanksgiving') a
  ON a.date = c.date"""))
def day_after_event(spark, sf_dir):
    cal = SalesPanel(spark, sf_dir).calendar_scan()
    ev = cal.filter(F.col("event_name_1") == "Thanksgiving")
    return enrich.day_after(cal.select("date"), ev, "after_thanksgiving")


@query("event_date_pairs", with_panel("""
SELECT a.year, a.date AS thanksgiving, b.date AS christmas
FROM (SELECT year, date FROM calendar WHERE event_name_1 = 'Thanksgiving') a
JOIN (SELECT year, date FROM calendar WHERE event_name_1 = 'Christmas') b USING (year)"""))
def event_date_pairs(spark, sf_dir):
    cal = SalesPanel(spark, sf_dir).calendar_scan()
    a = cal.filter(F.col("event_name_1") == "Thanksgiving").select("year", F.col("date").alias("thanksgiving"))
    b = cal.filter(F.col("event_name_1") == "Christmas").select("year", F.col("date").alias("christmas"))
    return a.join(b, "year")


_ENRICHED = """
enriched AS (
  SELECT s.item_id, s.date, s.sales_amount, c.wm_yr_wk, c.weekday, c.wday, c.month, c.year, c.d,
         c.event_name_1, c.event_type_1, c.event_name_2, c.event_type_2, c.snap_TX, p.sell_price
  FROM sales s JOIN calendar c USING (date)
  LEFT JOIN prices p ON p.item_id = s.item_id AND p.wm_yr_wk = c.wm_yr_wk)"""


def enriched(p: SalesPanel):
    return enrich.with_price_by_item(enrich.with_calendar(p.sales(), p.calendar()), p.prices().drop("store_id"))


@query("fill_defaults", with_panel("""
SELECT item_id, date, coalesce(sell_price, 0.0) AS sell_price,
       coalesce(event_name_1, 'No event') AS event_name_1, coalesce(event_type_1, 'No event type') AS event_type_1,
       coalesce(event_name_2, 'No event') AS event_name_2, coalesce(event_type_2, 'No event type') AS event_type_2
FROM enriched""", _ENRICHED))
def fill_defaults(spark, sf_dir):
    e = enriched(SalesPanel(spark, sf_dir))
    return features.fill_defaults(e).select("item_id", "date", "sell_price", "event_name_1", "event_type_1",
                                            "event_name_2", "event_type_2")


@query("mean_nonzero_sales", with_panel(
    "SELECT item_id, round(avg(nullif(sales_amount, 0)), 6) AS mean_sale_size FROM sales GROUP BY item_id"))
def mean_nonzero_sales(spark, sf_dir):
    s = SalesPanel(spark, sf_dir).sales()
    return s.groupBy("item_id").agg(F.round(F.avg(F.nullif("sales_amount", F.lit(0.0))), 6).alias("mean_sale_size"))


@query("round_forecast", with_panel("""
SELECT item_id, date, round_even(y_mean, 0) AS rounded FROM grid""",
    """last AS (SELECT item_id, max(date) AS last_date, avg(sales_amount) AS y_mean FROM train GROUP BY item_id),
grid AS (SELECT l.*, CAST(last_date + h AS DATE) AS date FROM last l, (SELECT CAST(range AS INTEGER) AS h FROM range(1, 29)) r)"""))
def round_forecast(spark, sf_dir):
    fc = naive.fc_mean(SalesPanel(spark, sf_dir).train())
    return fc.select("item_id", "date", F.bround("mean", 0).alias("rounded"))


@query("log_sales", with_panel("SELECT item_id, date, round(ln(1 + sales_amount), 6) AS log_sales FROM sales"))
def log_sales(spark, sf_dir):
    s = SalesPanel(spark, sf_dir).sales()
    return s.select("item_id", "date", F.round(F.log1p("sales_amount"), 6).alias("log_sales"))


@query("split_by_date", with_panel("""
SELECT * FROM sales WHERE date BETWEEN (SELECT lo FROM bounds) AND (SELECT hi - 28 FROM bounds)"""))
def split_by_date(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    return p.sales().filter(F.col("date").between(p.first_day(), p.train_end()))


@query("filter_items", with_panel("""
SELECT s.item_id, s.date, s.sales_amount, c.event_name_1
FROM sales s JOIN calendar c USING (date) WHERE c.event_name_1 IN ('Thanksgiving', 'Christmas')"""))
def filter_items(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    days = p.calendar().filter(F.col("event_name_1").isin("Thanksgiving", "Christmas")).select("date", "event_name_1")
    return p.sales().join(checked_broadcast(days), "date").select("item_id", "date", "sales_amount", "event_name_1")


@query("null_patterns", with_panel("""
SELECT 'both_events' AS pattern, count(*) AS n FROM calendar WHERE event_name_1 IS NOT NULL AND event_name_2 IS NOT NULL
UNION ALL SELECT 'only_second', count(*) FROM calendar WHERE event_name_1 IS NULL AND event_name_2 IS NOT NULL
UNION ALL SELECT 'name_type_mismatch', count(*) FROM calendar
  WHERE (event_name_1 IS NULL) <> (event_type_1 IS NULL) OR (event_name_2 IS NULL) <> (event_type_2 IS NULL)"""))
def null_patterns(spark, sf_dir):
    cal = SalesPanel(spark, sf_dir).calendar_scan()
    n1, n2 = F.col("event_name_1").isNull(), F.col("event_name_2").isNull()
    t1, t2 = F.col("event_type_1").isNull(), F.col("event_type_2").isNull()
    counts = cal.agg(
        F.count_if(~n1 & ~n2).alias("both_events"),
        F.count_if(n1 & ~n2).alias("only_second"),
        F.count_if((n1 != t1) | (n2 != t2)).alias("name_type_mismatch"))
    return counts.unpivot([], ["both_events", "only_second", "name_type_mismatch"], "pattern", "n")


@query("surrogate_ids", with_panel(
    "SELECT item_id, dense_rank() OVER (ORDER BY item_id) AS num FROM items"))
def surrogate_ids(spark, sf_dir):
    return reshape.dense_index(SalesPanel(spark, sf_dir).items(), "item_id", "num")


@query("day_ids", with_panel("""
SELECT date, CAST(date_diff('day', lo, date) + 1 AS INTEGER) AS day_no, d FROM calendar, bounds"""))
def day_ids(spark, sf_dir):
    p = SalesPanel(spark, sf_dir)
    first = p.first_day()
    return p.calendar_scan().select("date", (F.datediff("date", first) + 1).alias("day_no"),
                               reshape.day_label("date", first).alias("d"))
