"""Feature operators over the (item, date) panel: fills, price bands, lags,
percent changes, calendar flags (P12, W1-W12, pipeline A).

All order-dependent steps run over ``Window.partitionBy(key).orderBy(...)``,
so values never leak between items and every window shares one hash
exchange by item.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions import dates as D
from tillcast.session import reliable_checkpoint

# Fixed values of the study's fills and bands.
NO_EVENT = "No event"
NO_EVENT_TYPE = "No event type"
BAND_LABELS = ["low", "mid-low", "mid-high", "high"]
BAND_QUANTILES = [0.0, 0.25, 0.5, 0.75, 1.0]
WEEKEND_DAYS = ["Saturday", "Sunday"]
LAG7_COLUMNS = ["sell_price", "price_category", "sales_amount",
                "event_name_1", "event_name_2", "event_type_1", "event_type_2"]


def by_item(key: str = "item_id", order: str = "date"):
    return Window.partitionBy(key).orderBy(order)


def fill_defaults(df: DataFrame, price: str = "sell_price") -> DataFrame:
    """Price null -> 0, event names -> "No event", event types -> "No event type" (P12)."""
    fills = {}
    for c in df.columns:
        if c == price:
            fills[c] = 0.0
        elif c.startswith("event_name"):
            fills[c] = NO_EVENT
        elif c.startswith("event_type"):
            fills[c] = NO_EVENT_TYPE
    return df.fillna(fills)


def price_edges(train: DataFrame, price: str = "sell_price") -> DataFrame:
    """One row: exact (interpolated) quantiles 0, .25, .5, .75, 1 of the train prices.

    Rows are counted by value before the quantiles are taken from the counts.
    """
    counts = train.groupBy(price).agg(F.count("*").alias("_n"))
    return counts.agg(F.percentile(F.col(price), F.array(*[F.lit(q) for q in BAND_QUANTILES]), F.col("_n")).alias("edges"))


def band(x: Column, edges: Column, strict: bool = True) -> Column:
    """Right-closed bins (q0, q1], (q1, q2], ... labelled low..high.

    ``strict`` reproduces the study: the lowest edge itself and anything
    outside the edges fall to "low". Otherwise prices above the top edge
    are "high". Equal edges give empty bins.
    """
    q = [F.element_at(edges, i + 1) for i in range(5)]
    expr = None
    for i, lab in enumerate(BAND_LABELS):
        hit = (x > q[i]) & (x <= q[i + 1])
        expr = F.when(hit, F.lit(lab)) if expr is None else expr.when(hit, F.lit(lab))
    if not strict:
        expr = expr.when(x > q[4], F.lit("high"))
    return expr.otherwise(F.lit("low"))


def band_rank(label: Column) -> Column:
    expr = None
    for i, lab in enumerate(BAND_LABELS):
        expr = F.when(label == lab, F.lit(i)) if expr is None else expr.when(label == lab, F.lit(i))
    return expr


def lag_first_filled(c: str, n: int, key: str = "item_id", date: str = "date") -> Column:
    """Lag by ``n`` rows per item; the first ``n`` rows take the item's first value.

    Not a coalesce: a real null ``n`` rows back stays null.
    """
    w = by_item(key, date)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return F.when(F.row_number().over(w) <= n, F.first(c).over(whole)).otherwise(F.lag(c, n).over(w))


def lag7(df: DataFrame, cols: Sequence[str] = LAG7_COLUMNS, key: str = "item_id", date: str = "date",
         n: int = 7, origin: Column | None = None) -> DataFrame:
    """``lag7_<c>`` for each column. With ``origin`` set, lags whose source day
    lies after the forecast origin are nulled (no look-ahead)."""
    out = []
    for c in cols:
        e = lag_first_filled(c, n, key, date)
        if origin is not None:
            e = F.when(F.date_sub(F.col(date), n) <= origin, e)
        out.append(e.alias(f"lag7_{c}"))
    return df.select("*", *out)


def pct_change(value: str, period: str, key: str = "item_id", date: str = "date",
               period_col: str | None = None) -> Column:
    """Percent change of the per-(item, period) mean against the previous period.

    Two range frames over a consecutive period number give the current and
    previous period means without grouping and joining back. First period,
    division by zero and 0/0 give 0; then x100.
    """
    pn = F.col(period_col) if period_col else D.period_number(date, period)
    w = Window.partitionBy(key).orderBy(pn)
    cur = F.avg(value).over(w.rangeBetween(0, 0))
    prev = F.avg(value).over(w.rangeBetween(-1, -1))
    return F.coalesce(F.try_divide(cur - prev, prev), F.lit(0.0)) * F.lit(100.0)


def pct_changes(df: DataFrame, value: str = "sell_price", key: str = "item_id", date: str = "date",
                week_col: str | None = None) -> DataFrame:
    """Percent changes by week, month, quarter and year. Weeks are numbered
    through the calendar; ``week_col`` may name a week number instead, which
    must be consecutive (retail week ids jump at the turn of a year)."""
    return df.select(
        "*",
        pct_change(value, "week", key, date, period_col=week_col).alias("weekly_pct_change"),
        pct_change(value, "month", key, date).alias("monthly_pct_change"),
        pct_change(value, "quarter", key, date).alias("qrt_pct_change"),
        pct_change(value, "year", key, date).alias("yearly_pct_change"),
    )


def forward_fill(c: str, key: str = "item_id", date: str = "date") -> Column:
    """Last non-null value so far, per item; leading nulls stay null."""
    return F.last(c, ignorenulls=True).over(by_item(key, date).rowsBetween(Window.unboundedPreceding, 0))


def back_fill(c: str, key: str = "item_id", date: str = "date") -> Column:
    """Next non-null value, per item."""
    return F.first(c, ignorenulls=True).over(by_item(key, date).rowsBetween(0, Window.unboundedFollowing))


def calendar_flags(df: DataFrame, weekday: str = "weekday") -> DataFrame:
    """is_weekday / is_weekend by day name, is_holiday = number of events."""
    wk = F.col(weekday).isin(WEEKEND_DAYS)
    hol = ((F.col("event_name_1") != NO_EVENT).cast("int") + (F.col("event_name_2") != NO_EVENT).cast("int"))
    return df.select("*", (~wk).alias("is_weekday"), wk.alias("is_weekend"), hol.alias("is_holiday"))


def date_markers(df: DataFrame, date: str = "date") -> DataFrame:
    """day, quarter, month, ISO week (the study overwrites month with the same value)."""
    d = F.col(date)
    base = df.drop("month") if "month" in df.columns else df
    return base.select("*", F.dayofmonth(d).alias("day"), F.quarter(d).alias("quarter"),
                       F.month(d).alias("month"), F.weekofyear(d).alias("week"))


def build_features(sales: DataFrame, calendar: DataFrame, prices: DataFrame, train_end: Column,
                   key: str = "item_id", date: str = "date", strict_bands: bool = True,
                   origin_safe: bool = False, materialize: str | None = None) -> DataFrame:
    """The feature table of pipeline A.

    Plan with the panel source of ``tillcast.sources.panel``: the facts were
    read once into a sparse daily checkpoint; the dense panel is generated
    inside item partitions, the calendar is broadcast (one row per day), the
    weekly price is looked up by co-partitioning on item, and every window
    (first price, lag-7, four percent changes) reuses that partitioning, so
    the dense panel never crosses the network. The price-band edges are a
    scalar subquery over the same plan (recomputed from the sparse
    checkpoint, CPU only). ``materialize="checkpoint"`` instead writes the
    enriched panel to the shared checkpoint folder first (edges read it; one
    panel shuffle follows, since a checkpoint forgets its partitioning);
    ``"persist"`` caches it.
    """
    from tillcast.operators import enrich

    panel = enrich.with_calendar(sales, calendar.drop("lo") if "lo" in calendar.columns else calendar, date)
    panel = enrich.with_price_by_item(panel, prices.drop("store_id"), key, date=date)
    in_train = F.col(date) <= train_end
    w = Window.partitionBy(key)
    first_priced = F.min(F.when(F.col("sell_price").isNotNull() & in_train, F.col(date))).over(w)
    panel = panel.withColumn("week_added", F.coalesce((F.col(date) == first_priced).cast("int"), F.lit(0)))
    panel = fill_defaults(panel)
    if materialize == "checkpoint":
        panel = reliable_checkpoint(panel)
    elif materialize == "persist":
        panel = panel.persist()
    edges = price_edges(panel.filter(in_train)).scalar()
    panel = panel.withColumn("price_category", band(F.col("sell_price"), edges, strict_bands))
    panel = lag7(panel, key=key, date=date, origin=train_end if origin_safe else None)
    panel = pct_changes(panel, key=key, date=date)
    panel = calendar_flags(panel)
    return date_markers(panel, date)
