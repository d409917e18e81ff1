"""File sources and sinks.

Readers always take a declared schema (no inference pass over the data);
writers partition so later reads prune files. Scratch output goes under
the session's shared checkpoint folder, never a machine-local temp dir.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.session import checkpoint_dir

FORECAST_SCHEMA = T.StructType([
    T.StructField("item_id", T.StringType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("model", T.StringType(), False),
    T.StructField("mean", T.DoubleType(), True),
])


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    return os.path.join(checkpoint_dir(spark), kind, uuid.uuid4().hex)


def wide_schema(id_col: str, day_cols: list[str], value_type=T.DoubleType()) -> T.StructType:
    return T.StructType([T.StructField(id_col, T.StringType(), False)]
                        + [T.StructField(c, value_type, True) for c in day_cols])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with header and a declared schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    """CSV with header."""
    w = df.write.mode(mode).option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def read_labelled_csv(spark: SparkSession, path: str, schema: T.StructType, label_col: str = "_row") -> DataFrame:
    """CSV whose first column is a row label; the label is dropped."""
    full = T.StructType([T.StructField(label_col, T.LongType(), True)] + schema.fields)
    return read_csv(spark, path, full).drop(label_col)


def read_csv_folder(spark: SparkSession, folder: str, schema: T.StructType, tag: str = "model") -> DataFrame:
    """All ``*.csv`` files under ``folder``, tagged with the file's base name
    without extension (S3). A Spark-written ``<name>.csv/part-*.csv`` folder
    counts as one file named ``<name>``. The name comes from
    ``input_file_name()``, evaluated per file on the executors."""
    df = (spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True)
          .option("pathGlobFilter", "*.csv").csv(folder))
    return df.withColumn(tag, name_from_path())


def write_parquet(df: DataFrame, path: str, partition_by=("year", "month"), mode: str = "overwrite") -> None:
    """Partitioned parquet snapshot (S5). Rows meet by folder first, so each
    folder gets a few files; the date spreads a large folder over tasks."""
    if partition_by:
        df = df.repartition(*partition_by, *(["date"] if "date" in df.columns else []))
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def read_parquet(spark: SparkSession, path: str, after: Column | None = None) -> DataFrame:
    """Parquet snapshot (S4): column pruning and filters reach the scan.

    ``after`` keeps later dates; the year and month it implies prune the
    folders of a snapshot partitioned by them.
    """
    df = spark.read.parquet(path)
    if after is None:
        return df
    month = F.year(after) * 100 + F.month(after)
    return df.filter((F.col("year") * 100 + F.col("month") >= month) & (F.col("date") > after))


def name_from_path() -> Column:
    """The forecast's name: the CSV file's, or that of its Spark-written folder."""
    path = F.input_file_name()
    in_folder = F.regexp_extract(path, r"([^/]+)\.csv/part-[^/]*$", 1)
    return F.coalesce(F.nullif(in_folder, F.lit("")), F.regexp_extract(path, r"([^/]+?)\.csv$", 1))
