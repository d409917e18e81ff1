"""Date expressions: parsing, parts, week numbering, period keys.

Three week notions are kept apart (SURVEY §7.6 item 6): ``iso_week``
(ISO-8601 week number), ``wm_yr_wk`` (Saturday-based retail week id) and
``week_end`` (the Sunday that closes a Monday-Sunday resample bucket).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the retail week numbering: weeks start on Saturday,
# counted from the Saturday 1994-12-31, and numbered from 10000.
WEEK_ANCHOR = "1994-12-31"
WEEK_BASE = 10000


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_mdy(c) -> Column:
    """Parse text like ``1/29/2011`` (month/day/year)."""
    return F.to_date(col(c), "M/d/yyyy")


def parse_iso(c) -> Column:
    return F.to_date(col(c))


def week_end(c) -> Column:
    """Sunday closing the Monday-Sunday week of ``c`` (weekly resample key)."""
    return F.date_add(F.date_trunc("week", col(c)).cast("date"), 6)


def month_end(c) -> Column:
    return F.last_day(col(c))


def year_end(c) -> Column:
    return F.make_date(F.year(col(c)), F.lit(12), F.lit(31))


def retail_week(c) -> Column:
    """Retail week id: Saturday-based week count from the anchor."""
    return (F.lit(WEEK_BASE) + F.floor(F.datediff(col(c), F.lit(WEEK_ANCHOR).cast("date")) / 7)).cast("int")


def retail_wday(c) -> Column:
    """1 = Saturday, 2 = Sunday, ... 7 = Friday (1 and 2 are the weekend)."""
    return (F.pmod(F.datediff(col(c), F.lit(WEEK_ANCHOR).cast("date")), F.lit(7)) + 1).cast("int")


def weekday_name(c) -> Column:
    return F.date_format(col(c), "EEEE")


def period_number(c, period: str) -> Column:
    """Consecutive integer per period so neighbouring periods differ by 1.

    Used as a range-window order key: the previous period is ``-1`` exactly,
    whether or not the item has rows in it.
    """
    d = col(c)
    if period == "week":
        return F.floor(F.datediff(d, F.lit(WEEK_ANCHOR).cast("date")) / 7).cast("int")
    if period == "month":
        return (F.year(d) * 12 + F.month(d)).cast("int")
    if period == "quarter":
        return (F.year(d) * 4 + F.quarter(d)).cast("int")
    if period == "year":
        return F.year(d).cast("int")
    raise ValueError(period)


def period_start(c, period: str) -> Column:
    """``date_trunc`` key for joins on a calendar period."""
    return F.date_trunc(period, col(c)).cast("date")


def date_parts(c) -> list[Column]:
    d = col(c)
    return [
        F.dayofmonth(d).alias("day"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        F.weekofyear(d).alias("iso_week"),
        F.weekday(d).alias("weekday_no"),
        F.year(d).alias("year"),
    ]
