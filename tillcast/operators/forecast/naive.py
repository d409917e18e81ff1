"""Benchmark forecasts per series: mean, naive, drift, seasonal naive.

Each series is reduced by one grouped aggregation (partial aggregation
before the shuffle, one small row per series after it) and the horizon is
generated per series with ``explode(sequence(...))``: no driver loop, no
join against a date table, work linear in series x horizon.

Output of every model: ``key, date, model, mean`` (a "fable").
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def horizon_grid(last: DataFrame, key: str, h: int, last_col: str = "last_date") -> DataFrame:
    """Keys x the ``h`` days after each key's last date (J16), with step ``h_step``."""
    return last.select(
        "*",
        F.posexplode(F.sequence(F.date_add(F.col(last_col), 1), F.date_add(F.col(last_col), h))).alias("h_pos", "date"),
    ).withColumn("h_step", F.col("h_pos") + 1).drop("h_pos")


def _summary(train: DataFrame, key: str, y: str, date: str) -> DataFrame:
    return train.groupBy(key).agg(
        F.avg(y).alias("y_mean"),
        F.max_by(y, date).alias("y_last"),
        F.min_by(y, date).alias("y_first"),
        F.count(y).alias("n"),
        F.max(date).alias("last_date"),
    )


def fc_mean(train: DataFrame, key="item_id", y="sales_amount", date="date", h=28) -> DataFrame:
    s = _summary(train, key, y, date)
    return horizon_grid(s, key, h).select(key, "date", F.lit("mean").alias("model"), F.col("y_mean").alias("mean"))


def fc_naive(train: DataFrame, key="item_id", y="sales_amount", date="date", h=28) -> DataFrame:
    s = _summary(train, key, y, date)
    return horizon_grid(s, key, h).select(key, "date", F.lit("naive").alias("model"), F.col("y_last").alias("mean"))


def fc_drift(train: DataFrame, key="item_id", y="sales_amount", date="date", h=28) -> DataFrame:
    """last + h * (last - first) / (n - 1); a one-point series has no slope."""
    s = _summary(train, key, y, date)
    slope = F.when(F.col("n") > 1, (F.col("y_last") - F.col("y_first")) / (F.col("n") - 1)).otherwise(F.lit(0.0))
    return horizon_grid(s, key, h).select(
        key, "date", F.lit("drift").alias("model"), (F.col("y_last") + F.col("h_step") * slope).alias("mean"))


def fc_snaive(train: DataFrame, key="item_id", y="sales_amount", date="date", h=28, season=7) -> DataFrame:
    """Seasonal naive: each horizon day repeats the same position of the last season.

    One aggregation by (key, slot) keeps the last value of every season slot
    (``slot = day number mod season``); each slot then spans its horizon days
    ``last_slot_date + season * k``. The per-key end date comes from a window
    over the ``season`` summary rows per key, not over the facts.
    """
    slot = F.pmod(F.datediff(F.col(date), F.lit("1970-01-01").cast("date")), F.lit(season))
    per_slot = (train.groupBy(key, slot.alias("slot"))
                .agg(F.max(date).alias("slot_last"), F.max_by(y, date).alias("value")))
    end = F.max("slot_last").over(Window.partitionBy(key))
    reps = (h + season - 1) // season
    return (per_slot.withColumn("last_date", end)
            .select(key, "value", "last_date",
                    F.explode(F.sequence(F.lit(1), F.lit(reps))).alias("k"), "slot_last")
            .withColumn("date", F.date_add("slot_last", F.col("k") * season))
            .filter(F.col("date") <= F.date_add("last_date", h))
            .filter(F.col("date") > F.col("last_date"))
            .select(key, "date", F.lit("snaive").alias("model"), F.col("value").alias("mean")))


def naive_family(train: DataFrame, key="item_id", y="sales_amount", date="date", h=28) -> DataFrame:
    """All four benchmark models from one summary aggregation plus seasonal naive."""
    s = _summary(train, key, y, date)
    g = horizon_grid(s, key, h)
    slope = F.when(F.col("n") > 1, (F.col("y_last") - F.col("y_first")) / (F.col("n") - 1)).otherwise(F.lit(0.0))
    models = F.array(
        F.struct(F.lit("mean").alias("model"), F.col("y_mean").alias("mean")),
        F.struct(F.lit("naive").alias("model"), F.col("y_last").alias("mean")),
        F.struct(F.lit("drift").alias("model"), (F.col("y_last") + F.col("h_step") * slope).alias("mean")),
    )
    three = g.select(key, "date", F.explode(models).alias("m")).select(key, "date", "m.model", "m.mean")
    return three.unionByName(fc_snaive(train, key, y, date, h))
