"""The demand panel derived from the driver's star-schema tables.

The study works on daily unit sales per item, a calendar with events and
weekly prices. Here those roles are played by Spark jobs over ``lineitem``
and ``part`` (SURVEY §7.3):

* item: ``p_type`` + ``_`` + brand number (``item_grain="part"`` uses the
  part key instead, for scale runs);
* sales: ``sum(l_quantity)`` per item and ship day, densified with zeros
  over every day between the first and last ship date;
* prices: whole-cent average price per item and retail week
  (integer sums first, one division);
* calendar: every day from the first ship date to 28 days past the last,
  with retail week ids, rule-made events and a SNAP flag.

The date bounds are read once per panel (one aggregate row over the ship
date column) and used as literals, so no later plan re-scans the facts for
them and none joins against a one-row frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.functions import dates as D
from tillcast.session import reliable_checkpoint, ship_package

# Fixed values of the panel definition.
STORE_ID = "TX_3"
ID_SUFFIX = "_TX_3_validation"
HORIZON = 28
CALENDAR_EXTRA_DAYS = 28
SNAP_DAYS = [1, 3, 5, 6, 7, 9, 11, 12, 13, 15]
# (month, day, event name, event type); Thanksgiving is the 4th Thursday of November.
FIXED_DATE_EVENTS = [
    (1, 1, "NewYear", "National"),
    (2, 14, "ValentinesDay", "Cultural"),
    (12, 25, "Christmas", "National"),
]
THANKSGIVING = ("Thanksgiving", "National")
# Second event of a day: set when the first event falls on a Sunday.
SUNDAY_SECOND_EVENT = ("SundayMarket", "Cultural")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class SalesPanel:
    """Lazy views of the demand panel over one folder of driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, item_grain: str = "brand_type",
                 horizon: int = HORIZON):
        if item_grain not in ("brand_type", "part"):
            raise ValueError(item_grain)
        ship_package(spark)
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.item_grain = item_grain
        self.horizon = horizon

    # -- raw inputs, pruned to the columns used --------------------------------
    def lines(self) -> DataFrame:
        li = read_table(self.spark, self.sf_dir, "lineitem")
        return li.select(
            "l_partkey",
            F.col("l_shipdate").cast("date").alias("date"),
            F.col("l_quantity").alias("qty"),
            F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        )

    def _item_expr(self) -> Column:
        if self.item_grain == "part":
            return F.col("p_partkey").cast("string")
        return F.concat(F.col("p_type"), F.lit("_"), F.regexp_replace("p_brand", "Brand#", ""))

    def part_items(self) -> DataFrame:
        """p_partkey -> item_id (grows with the data: no broadcast hint;
        the planner broadcasts it only under its size threshold)."""
        p = read_table(self.spark, self.sf_dir, "part")
        return p.select("p_partkey", self._item_expr().alias("item_id"))

    def items(self) -> DataFrame:
        """Distinct items with their submission id."""
        return (self.part_items().select("item_id").distinct()
                .withColumn("id", F.concat("item_id", F.lit(ID_SUFFIX))))

    # -- date bounds, read once and used as literals -------------------------
    def first_day(self) -> Column:
        return F.lit(self.bounds_values()[0])

    def last_day(self) -> Column:
        return F.lit(self.bounds_values()[1])

    def bounds_values(self):
        """(first, last) ship date as Python dates: one aggregate row over
        the date column of all lines, whether or not their part is known."""
        if getattr(self, "_bounds", None) is None:
            r = self._bounds_row().first()
            self._bounds = (r["lo"], r["hi"])
        return self._bounds

    def _bounds_row(self) -> DataFrame:
        return self.lines().agg(F.min("date").alias("lo"), F.max("date").alias("hi"))

    def day_labels(self) -> list[str]:
        """``d_N`` labels of every day of the history, in order."""
        lo, hi = self.bounds_values()
        return [f"d_{n}" for n in range(1, (hi - lo).days + 2)]

    def test_labels(self) -> list[str]:
        """``d_N`` labels of the held-out days, in order."""
        lo, hi = self.bounds_values()
        n_hi = (hi - lo).days + 1
        return [f"d_{n}" for n in range(n_hi - self.horizon + 1, n_hi + 1)]

    def train_end(self) -> Column:
        return F.date_sub(self.last_day(), self.horizon)

    def test_start(self) -> Column:
        return F.date_sub(self.last_day(), self.horizon - 1)

    # -- facts -------------------------------------------------------------
    def facts(self) -> DataFrame:
        li = self.lines()
        return li.join(self.part_items(), li.l_partkey == F.col("p_partkey")).select(
            "item_id", "date", "qty", "cents")

    def daily(self) -> DataFrame:
        """Sparse daily totals per item: the only pass over the facts.

        ``groupBy(item, date)`` with map-side partial aggregation spreads even
        a hot item over its days; the result (at most one row per item-day
        with sales) is checkpointed into the shared folder once per panel, so
        sales, prices, bounds and every query built on them read it instead
        of the facts, and a lost executor never re-reads ``lineitem``.
        """
        if getattr(self, "_daily", None) is None:
            d = self.facts().groupBy("item_id", "date").agg(
                F.sum("qty").alias("qty"), F.sum("cents").alias("cents"),
                F.sum(F.col("qty").cast("bigint")).alias("units"))
            self._daily = reliable_checkpoint(d)
        return self._daily

    def _by_item(self, df: DataFrame) -> DataFrame:
        """Hash-partition by item with the session's partition count; Spark
        drops the shuffle when the input is already partitioned that way."""
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return df.repartition(n, "item_id")

    def sales(self, since: Column | None = None) -> DataFrame:
        """Dense long sales: item_id, date, sales_amount (0 on days without sales).

        Only the sparse daily rows move (hash-partitioned by item); the zero
        grid is generated inside each item's partition with
        ``explode(sequence(...))`` and merged by an aggregation that needs no
        further shuffle. The dense panel is never shuffled, and it comes out
        hash-partitioned by item, which every later per-item window reuses.
        ``since`` builds the days from that date on only.
        """
        first = self.first_day() if since is None else since
        daily = self.daily() if since is None else self.daily().filter(F.col("date") >= since)
        grid = self._by_item(self.items().select("item_id")).select(
            "item_id",
            F.explode(F.sequence(first, self.last_day())).alias("date"),
            F.lit(0.0).alias("qty"))
        f = self._by_item(daily.select("item_id", "date", "qty"))
        return (grid.unionByName(f).groupBy("item_id", "date")
                .agg(F.sum("qty").alias("sales_amount")))

    def train(self) -> DataFrame:
        return self.sales().filter(F.col("date") <= self.train_end())

    def test(self) -> DataFrame:
        return self.sales(since=self.test_start())

    def prices(self) -> DataFrame:
        """store_id, item_id, wm_yr_wk, sell_price in whole cents.

        Weeks without sales have no row, as weeks before an item's
        introduction have none in the study's price file. Built from the
        item-partitioned daily rows, so it is partitioned by item as well.
        """
        d = self._by_item(self.daily()).withColumn("wm_yr_wk", D.retail_week("date"))
        return (d.groupBy("item_id", "wm_yr_wk")
                .agg(F.sum("cents").alias("c"), F.sum("units").alias("u"))
                .select(F.lit(STORE_ID).alias("store_id"), "item_id", "wm_yr_wk",
                        (F.floor(F.col("c") / F.col("u")) / F.lit(100.0).cast("double")).alias("sell_price")))

    def calendar_scan(self) -> DataFrame:
        """The calendar as a plan over the lines' own dates: one aggregate of
        the date column, then a row for each day between its ends."""
        days = self._bounds_row().select(
            F.explode(F.sequence("lo", F.date_add("hi", CALENDAR_EXTRA_DAYS))).alias("date"), "lo")
        return calendar_columns(days, F.col("lo")).drop("lo")

    def calendar(self) -> DataFrame:
        """One row per day from the known bounds, for joins with the panel
        (no further scan of the facts); bounded by the date range."""
        lo, hi = self.bounds_values()
        n_days = (hi - lo).days + 1 + CALENDAR_EXTRA_DAYS
        days = self.spark.range(0, n_days, numPartitions=1).select(
            F.date_add(F.lit(lo), F.col("id").cast("int")).alias("date"))
        return calendar_columns(days, F.lit(lo))


def event_columns(d: Column) -> list[Column]:
    md = F.month(d) * 100 + F.dayofmonth(d)
    name1 = F.lit(None).cast("string")
    type1 = F.lit(None).cast("string")
    thanks = (F.month(d) == 11) & (F.dayofweek(d) == 5) & F.dayofmonth(d).between(22, 28)
    name1 = F.when(thanks, F.lit(THANKSGIVING[0]))
    type1 = F.when(thanks, F.lit(THANKSGIVING[1]))
    for m, day, nm, tp in FIXED_DATE_EVENTS:
        hit = md == m * 100 + day
        name1 = name1.when(hit, F.lit(nm))
        type1 = type1.when(hit, F.lit(tp))
    sunday = F.dayofweek(d) == 1
    has1 = name1.isNotNull()
    name2 = F.when(has1 & sunday, F.lit(SUNDAY_SECOND_EVENT[0]))
    type2 = F.when(has1 & sunday, F.lit(SUNDAY_SECOND_EVENT[1]))
    return [name1.alias("event_name_1"), type1.alias("event_type_1"),
            name2.alias("event_name_2"), type2.alias("event_type_2")]


def calendar_columns(days: DataFrame, first_day: Column) -> DataFrame:
    d = F.col("date")
    return days.select(
        "*",
        D.retail_week(d).alias("wm_yr_wk"),
        D.weekday_name(d).alias("weekday"),
        D.retail_wday(d).alias("wday"),
        F.month(d).alias("month"),
        F.year(d).alias("year"),
        F.concat(F.lit("d_"), (F.datediff(d, first_day) + 1).cast("string")).alias("d"),
        *event_columns(d),
        F.dayofmonth(d).isin(SNAP_DAYS).cast("int").alias("snap_TX"),
    )
