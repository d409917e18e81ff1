"""Queries: file sources and sinks."""

from __future__ import annotations

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.operators import reshape, score
from tillcast.operators.forecast import naive
from tillcast.plans.oracle import with_panel
from tillcast.plans.q_features import FEATURE_CTES, PCT, feature_table
from tillcast.plans.q_forecast import FAMILY_CTES
from tillcast.plans.q_reshape import _SALES_LONG, _pivot_sql, sales_wide
from tillcast.plans.registry import query
from tillcast.sources import files
from tillcast.session import reliable_checkpoint
from tillcast.sources.panel import SalesPanel


@query("scan_csv", with_panel(_SALES_LONG))
def scan_csv(spark, sf_dir):
    """Wide actuals written as CSV, read back with a declared schema, melted."""
    p = SalesPanel(spark, sf_dir)
    path = files.scratch_path(spark, "csv")
    files.write_csv(sales_wide(p), path)
    back = files.read_csv(spark, path, files.wide_schema("id", p.day_labels()))
    return reshape.melt(back, ["id"], prefix="d_", var_name="d", value_name="sales")


@query("scan_forecast_csv", with_panel("""
SELECT i.id, 'd_' || CAST(date_diff('day', b.lo, f.date) + 1 AS VARCHAR) AS d, f.mean AS sales
FROM family f JOIN items i USING (item_id), bounds b WHERE f.model = 'naive'""", FAMILY_CTES))
def scan_forecast_csv(spark, sf_dir):
    """A wide forecast file with a leading row-label column, label dropped on read."""
    p = SalesPanel(spark, sf_dir)
    labels = p.test_labels()
    fc = naive.fc_naive(p.train()).join(p.items(), "item_id").withColumn("d", reshape.day_label("date", p.first_day()))
    wide = reshape.pivot_wide(fc, "id", "d", "mean", labels)
    wide = wide.select(F.monotonically_increasing_id().alias("_row"), *wide.columns)
    path = files.scratch_path(spark, "csv")
    files.write_csv(wide, path)
    back = files.read_labelled_csv(spark, path, files.wide_schema("id", labels))
    return reshape.melt(back, ["id"], prefix="d_", var_name="d", value_name="sales")


def write_forecast_folder(spark, p: SalesPanel) -> str:
    """One ``<model>.csv`` per model of the naive family, in a fresh folder."""
    folder = files.scratch_path(spark, "forecasts")
    fam = naive.naive_family(p.train())
    for m in ("mean", "naive", "drift", "snaive"):
        files.write_csv(fam.filter(F.col("model") == m).drop("model"), os.path.join(folder, f"{m}.csv"))
    return folder


_FC_SCHEMA = T.StructType([f for f in files.FORECAST_SCHEMA.fields if f.name != "model"])


@query("scan_forecast_dir", with_panel("""
SELECT model, round(avg(rmse), 6) AS rmse, count(*) AS n_items
FROM (SELECT model, item_id, sqrt(avg((y - round(yhat, 6)) ^ 2)) AS rmse FROM aligned GROUP BY model, item_id)
GROUP BY model""", FAMILY_CTES))
def scan_forecast_dir(spark, sf_dir):
    """Folder of per-model forecast files -> one table tagged by file name -> per-item RMSE."""
    p = SalesPanel(spark, sf_dir)
    fc = files.read_csv_folder(spark, write_forecast_folder(spark, p), _FC_SCHEMA)
    fc = fc.withColumn("mean", F.round("mean", 6))
    out = score.rmse_per_item_mean(score.align(fc, p.test(), fill_missing=0.0))
    return out.withColumn("rmse", F.round("rmse", 6))


def _features_snapshot(spark, p: SalesPanel):
    path = files.scratch_path(spark, "features")
    files.write_parquet(feature_table(p), path)
    return path


@query("scan_features", with_panel(
    "SELECT * REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in PCT) + ") FROM features"
    " WHERE date > (SELECT hi - 28 FROM bounds)", FEATURE_CTES))
def scan_features(spark, sf_dir):
    """Partitioned parquet snapshot read back with a date filter (pruned by year/month)."""
    p = SalesPanel(spark, sf_dir)
    out = files.read_parquet(spark, _features_snapshot(spark, p), after=p.train_end())
    for c in PCT:
        out = out.withColumn(c, F.round(c, 6))
    return out


@query("write_features", with_panel('SELECT year, month, count(*) AS "rows" FROM features GROUP BY year, month', FEATURE_CTES))
def write_features(spark, sf_dir):
    """Rows per written (year, month) partition of the feature snapshot."""
    snap = files.read_parquet(spark, _features_snapshot(spark, SalesPanel(spark, sf_dir)))
    return snap.groupBy("year", "month").agg(F.count("*").alias("rows"))


@query("write_submission", with_panel(_pivot_sql("family", "model, id"), FAMILY_CTES))
def write_submission(spark, sf_dir):
    """Per-model wide submissions written as CSV partitioned by model, read back."""
    p = SalesPanel(spark, sf_dir)
    labels = p.test_labels()
    fam = naive.naive_family(p.train()).join(p.items(), "item_id")
    long = fam.withColumn("d", reshape.day_label("date", p.first_day())).withColumn("mean", F.bround("mean", 0))
    wide = long.groupBy("model", "id").pivot("d", labels).agg(F.avg("mean"))
    path = files.scratch_path(spark, "submissions")
    files.write_csv(wide, path, partition_by=["model"])
    schema = files.wide_schema("id", labels)
    return spark.read.schema(schema).option("header", True).csv(path)


@query("stream_leaderboard", with_panel("""
SELECT a.model, a.rmse, a.n_items, b.rmse_per_day, b.n_days, c.rmse_pooled, c.mae, CAST(0 AS BIGINT) AS n_absent
FROM (SELECT model, round(avg(rmse), 6) AS rmse, count(*) AS n_items
      FROM (SELECT model, item_id, sqrt(avg((y - yhat) ^ 2)) AS rmse FROM aligned GROUP BY model, item_id) GROUP BY model) a
JOIN (SELECT model, round(avg(rmse_day), 6) AS rmse_per_day, count(*) AS n_days
      FROM (SELECT model, date, sqrt(avg((y - yhat) ^ 2)) AS rmse_day FROM aligned GROUP BY model, date) GROUP BY model) b
  USING (model)
JOIN (SELECT model, round(sqrt(avg((y - yhat) ^ 2)), 6) AS rmse_pooled, round(avg(abs(y - yhat)), 6) AS mae
      FROM aligned GROUP BY model) c USING (model)""", FAMILY_CTES.replace(
    "f.mean AS yhat FROM family f", "round(f.mean, 6) AS yhat FROM family f")))
def stream_leaderboard(spark, sf_dir):
    """Forecast files scored as a Structured Streaming job, one model per micro-batch."""
    from tillcast.streaming import forecast_stream

    p = SalesPanel(spark, sf_dir)
    folder = write_forecast_folder(spark, p)
    lb = forecast_stream.run_once(spark, folder, reliable_checkpoint(p.test()), files.scratch_path(spark, "stream"))
    return lb.select("model", F.round("rmse", 6).alias("rmse"), "n_items",
                     F.round("rmse_per_day", 6).alias("rmse_per_day"), "n_days",
                     F.round("rmse_pooled", 6).alias("rmse_pooled"), F.round("mae", 6).alias("mae"), "n_absent")
