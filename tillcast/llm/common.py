"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.session import checkpoint_dir, ship_package

#: Bytes of text that one numpy pass of a task works on; a longer text is a pass of its own.
PIECE_BYTES = 1 << 20
#: Rows of an Arrow batch between Spark and Python: whole texts travel in them, so fewer than Spark's default of 10,000.
BATCH_ROWS = 1000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepare(spark: SparkSession) -> None:
    """Make the package importable on the executors and bound the Arrow batches, unless the session says otherwise."""
    ship_package(spark)
    if spark.conf.get(_BATCH_CONF, "10000") == "10000":
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet into the shared folder and read back.

    Cuts the lineage: later steps, and steps repeated after a lost executor,
    read the files. The folder is the one ``spark.checkpoint.dir`` names.
    """
    spark = df.sparkSession
    prepare(spark)
    path = f"{checkpoint_dir(spark).rstrip('/')}/tillcast-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def pieces(batches, column: int = 0, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows whose ``column`` holds about ``limit`` bytes."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        offsets, _ = text_buffers(batch.column(column))
        start = 0
        while start < n:
            end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            end = min(n, max(end, start + 1))
            yield batch.slice(start, end - start)
            start = end


def text_buffers(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (int64, rows + 1) and bytes of a string or binary column; null counts as empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if not pa.types.is_large_binary(array.type):
        array = array.cast(pa.binary()).cast(pa.large_binary())
    if array.null_count:
        array = array.fill_null(b"")
    _, offsets, data = array.buffers()
    off = np.frombuffer(offsets, np.int64, len(array) + 1, array.offset * 8) if len(array) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return off, raw


def bucket_names(keys: DataFrame, by: list[str], name: str = "name", buckets: int | None = None) -> DataFrame:
    """Integer names for the distinct values of ``by``: equal rows get the same name, others another.

    Rows are dealt by a hash of the value into buckets, each bucket is sorted
    and its distinct values counted off (dense rank); the name is the bucket
    number before the rank. Two values never share a name, whatever their hash.
    """
    from pyspark.sql import Window

    buckets = buckets or 4 * shuffle_parts(keys.sparkSession)
    rank = F.dense_rank().over(Window.partitionBy("__bucket").orderBy(*by))
    return (keys.withColumn("__bucket", F.pmod(F.xxhash64(*by), F.lit(buckets)))
            .withColumn(name, F.col("__bucket") * F.lit(1 << 40) + rank)
            .drop("__bucket"))


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (the splitmix64 finalizer; a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A 64-bit number for each byte value, and the odd base of the position weights.
BYTE_NUMBERS = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = 0x5851F42D4C957F2D


def powers(n: int) -> np.ndarray:
    """BASE ** 0 ... BASE ** (n - 1) modulo 2^64."""
    out = np.full(max(n, 1), BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def span_hashes(numbers: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of ``numbers`` from one start to the next (the last to the end)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    length = np.diff(starts, append=len(numbers))
    weight = powers(int(length.max()))
    place = np.arange(len(numbers)) - np.repeat(starts, length) if starts[0] == 0 else None
    if place is None:
        numbers, starts = numbers[starts[0]:], starts - starts[0]
        place = np.arange(len(numbers)) - np.repeat(starts, length)
    return mix64(np.add.reduceat(numbers * weight[place], starts))


def ragged(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions first[0] ... first[0] + length[0] - 1, first[1] ..., run after run."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(first - (ends - length), length) + np.arange(total)
