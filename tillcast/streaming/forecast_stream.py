"""Incremental scoring of forecast files as they land in a folder.

The study scores a folder of per-model forecast files in one pass
(S3 + M7). As a stream: a file source over the folder (declared schema,
bounded files per micro-batch) and ``foreachBatch`` that aligns each batch
with the actuals and appends *additive* error sums per (model, item) and
(model, day). A model whose files arrive over several batches simply adds
more sums; the leaderboard is an aggregation over the sums when read.

Exactly-once: each batch writes its own ``batch_id`` partition with dynamic
partition overwrite, so a batch replayed after a failure replaces its own
output instead of duplicating it; progress lives in the checkpoint folder.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.operators import score
from tillcast.sources.files import name_from_path

FILE_SCHEMA = T.StructType([
    T.StructField("item_id", T.StringType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("mean", T.DoubleType(), True),
])


def score_stream(spark: SparkSession, folder: str, actual: DataFrame, out_path: str, checkpoint: str,
                 files_per_batch: int = 4):
    """Start the stream; returns the ``StreamingQuery``."""
    src = (spark.readStream.schema(FILE_SCHEMA).option("header", True)
           .option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
           .option("maxFilesPerTrigger", files_per_batch).csv(folder))
    tagged = src.withColumn("model", name_from_path())

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        a = score.align(batch, actual, fill_missing=0.0)
        e = F.col("y") - F.col("yhat")
        # one pass: both groupings of the aligned batch, told apart by ``by_day``
        (a.groupingSets([[F.col("model"), F.col("item_id")], [F.col("model"), F.col("date")]], "model", "item_id", "date")
         .agg(F.sum(e * e - F.col("y") * F.col("y")).alias("sse"), F.sum(F.abs(e) - F.abs("y")).alias("sae"),
              F.count("*").alias("n"), F.grouping("item_id").alias("by_day"))
         .withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out_path))

    return (tagged.writeStream.foreachBatch(score_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_leaderboard(spark: SparkSession, out_path: str, actual: DataFrame) -> DataFrame:
    """RMSE per item then mean, RMSE per day then mean, pooled RMSE and MAE; absent forecasts count as 0.

    A batch stores by how much its forecasts change the errors that an
    all-zero forecast would have; those base errors come from the actuals,
    once for each model, when the sums are read.
    """
    got = spark.read.parquet(out_path)
    models = score.models_of(got)
    zero = score.every_model(actual, models).groupingSets(
        [[F.col("model"), F.col("item_id")], [F.col("model"), F.col("date")]], "model", "item_id", "date").agg(
        F.sum(F.col("y") * F.col("y")).alias("sse"), F.sum(F.abs("y")).alias("sae"), F.count("*").alias("rows"),
        F.lit(0).cast("long").alias("n"), F.grouping("item_id").alias("by_day"))
    seen = got.withColumn("rows", F.lit(0).cast("long")).select(zero.columns)
    sums = zero.unionByName(seen).groupBy("model", "item_id", "date", "by_day").agg(
        F.sum("sse").alias("sse"), F.sum("sae").alias("sae"), F.sum("rows").alias("rows"), F.sum("n").alias("n"))
    rmse, item, day = F.sqrt(F.col("sse") / F.col("rows")), F.col("by_day") == 0, F.col("by_day") == 1
    of_items = lambda c: F.sum(F.when(item, F.col(c)))
    return sums.groupBy("model").agg(
        F.avg(F.when(item, rmse)).alias("rmse"), F.count_if(item).alias("n_items"),
        F.avg(F.when(day, rmse)).alias("rmse_per_day"), F.count_if(day).alias("n_days"),
        F.sqrt(of_items("sse") / of_items("rows")).alias("rmse_pooled"), (of_items("sae") / of_items("rows")).alias("mae"),
        (of_items("rows") - of_items("n")).alias("n_absent"))


def run_once(spark: SparkSession, folder: str, actual: DataFrame, work_dir: str) -> DataFrame:
    out = os.path.join(work_dir, "sums")
    q = score_stream(spark, folder, actual, out, os.path.join(work_dir, "_ckpt"))
    q.awaitTermination()
    return read_leaderboard(spark, out, actual)
