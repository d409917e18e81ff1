"""DuckDB oracle SQL: an independent statement of each query's result.

Every statement starts from the raw driver views (``lineitem``, ``part``)
and restates the panel of ``tillcast.sources.panel`` in DuckDB's dialect,
so the check covers the panel derivation too. Spellings that differ from
Spark: ``date_diff('day', a, b)`` for ``datediff(b, a)``,
``generate_series`` for ``sequence``, ``dayofweek`` 0 = Sunday,
``round_even`` for ``bround``, ``quantile_cont`` for ``percentile``.
"""

from __future__ import annotations

PANEL_CTES = """
li AS (
  SELECT l_partkey, CAST(l_shipdate AS DATE) AS date, l_quantity AS qty,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS cents
  FROM lineitem),
part_items AS (
  SELECT p_partkey, p_type || '_' || replace(p_brand, 'Brand#', '') AS item_id FROM part),
items AS (
  SELECT DISTINCT item_id, item_id || '_TX_3_validation' AS id FROM part_items),
bounds AS (SELECT min(date) AS lo, max(date) AS hi FROM li),
facts AS (
  SELECT item_id, date, qty, cents FROM li JOIN part_items ON l_partkey = p_partkey),
spine AS (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds),
sales AS (
  SELECT i.item_id, s.date, coalesce(d.qty, 0.0) AS sales_amount
  FROM items i CROSS JOIN spine s
  LEFT JOIN (SELECT item_id, date, sum(qty) AS qty FROM facts GROUP BY item_id, date) d
    ON d.item_id = i.item_id AND d.date = s.date),
train AS (SELECT * FROM sales WHERE date <= (SELECT hi - 28 FROM bounds)),
test AS (SELECT * FROM sales WHERE date >= (SELECT hi - 27 FROM bounds)),
prices AS (
  SELECT 'TX_3' AS store_id, item_id, wm_yr_wk,
         floor(sum(cents) / sum(CAST(qty AS BIGINT))) / 100.0 AS sell_price
  FROM (SELECT *, CAST(10000 + floor(date_diff('day', DATE '1994-12-31', date) / 7) AS INTEGER) AS wm_yr_wk
        FROM facts)
  GROUP BY item_id, wm_yr_wk),
cal_days AS (
  SELECT CAST(unnest(generate_series(lo, hi + 28, INTERVAL 1 DAY)) AS DATE) AS date, lo FROM bounds),
calendar AS (
  SELECT date,
    CAST(10000 + floor(date_diff('day', DATE '1994-12-31', date) / 7) AS INTEGER) AS wm_yr_wk,
    dayname(date) AS weekday,
    CAST(date_diff('day', DATE '1994-12-31', date) % 7 + 1 AS INTEGER) AS wday,
    CAST(month(date) AS INTEGER) AS month,
    CAST(year(date) AS INTEGER) AS year,
    'd_' || CAST(date_diff('day', lo, date) + 1 AS VARCHAR) AS d,
    ev1 AS event_name_1,
    CASE ev1 WHEN 'Thanksgiving' THEN 'National' WHEN 'NewYear' THEN 'National'
             WHEN 'ValentinesDay' THEN 'Cultural' WHEN 'Christmas' THEN 'National' END AS event_type_1,
    CASE WHEN ev1 IS NOT NULL AND dayofweek(date) = 0 THEN 'SundayMarket' END AS event_name_2,
    CASE WHEN ev1 IS NOT NULL AND dayofweek(date) = 0 THEN 'Cultural' END AS event_type_2,
    CAST(day(date) IN (1, 3, 5, 6, 7, 9, 11, 12, 13, 15) AS INTEGER) AS snap_TX
  FROM (SELECT date, lo,
          CASE WHEN month(date) = 11 AND dayofweek(date) = 4 AND day(date) BETWEEN 22 AND 28 THEN 'Thanksgiving'
               WHEN month(date) = 1 AND day(date) = 1 THEN 'NewYear'
               WHEN month(date) = 2 AND day(date) = 14 THEN 'ValentinesDay'
               WHEN month(date) = 12 AND day(date) = 25 THEN 'Christmas' END AS ev1
        FROM cal_days))
"""


def with_panel(select: str, extra_ctes: str = "") -> str:
    """Prefix ``select`` with the panel CTEs (and optional extra CTEs)."""
    ctes = PANEL_CTES.strip()
    if extra_ctes.strip():
        ctes = ctes + ",\n" + extra_ctes.strip().rstrip(",")
    return f"WITH {ctes}\n{select.strip()}"
