"""Reshaping: wide <-> long, id parsing, surrogate ids, day labels.

Wide tables exist only at the edges (input and submission files); all work
in between is long and keyed by (item, date).
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.session import reliable_checkpoint

# Fixed value: an id is <item>_<loc1>_<loc2>_<type>, split from the right.
ID_PATTERN = r"^(.*)_([^_]+)_([^_]+)_([^_]+)$"


def melt(df: DataFrame, ids: Sequence[str], prefix: str | None = None, values: Sequence[str] | None = None,
         var_name: str = "d", value_name: str = "sales") -> DataFrame:
    """Wide -> long over all non-id columns, or those starting with ``prefix``."""
    if values is None:
        values = [c for c in df.columns if c not in ids and (prefix is None or c.startswith(prefix))]
    return df.unpivot(list(ids), list(values), var_name, value_name)


def day_label_to_date(label: Column | str, first_day: Column) -> Column:
    """``d_N`` -> first_day + N - 1 (R2), without renaming columns."""
    lab = F.col(label) if isinstance(label, str) else label
    n = F.regexp_extract(lab, r"^d_(\d+)$", 1).cast("int")
    return F.date_add(first_day, n - 1)


def day_label(date: Column | str, first_day: Column) -> Column:
    """Date -> ``d_N`` label by day number from the first day."""
    d = F.col(date) if isinstance(date, str) else date
    return F.concat(F.lit("d_"), (F.datediff(d, first_day) + 1).cast("string"))


def pivot_wide(long: DataFrame, id_col: str, label_col: str, value_col: str, labels: Sequence[str]) -> DataFrame:
    """Long -> wide with an explicit label list (no extra distinct pass)."""
    return long.groupBy(id_col).pivot(label_col, list(labels)).agg(F.avg(value_col))


def split_id(c: str = "id") -> list[Column]:
    """Split an id into item, loc1, loc2, type from the right."""
    return [F.regexp_extract(F.col(c), ID_PATTERN, k).alias(n)
            for k, n in ((1, "item_id"), (2, "loc1"), (3, "loc2"), (4, "type"))]


def extract_item(c: str, pattern: str) -> Column:
    """First regex match or NULL when there is none."""
    return F.nullif(F.regexp_extract(F.col(c), pattern, 0), F.lit(""))


def concat_checked(a: DataFrame, b: DataFrame) -> DataFrame:
    """Vertical concat of equal-schema tables; fails on column mismatch."""
    if a.columns != b.columns:
        raise ValueError(f"column mismatch: {a.columns} vs {b.columns}")
    return a.unionByName(b)


def dense_index(df: DataFrame, order_col: str, out_col: str = "num") -> DataFrame:
    """Consecutive 1-based number by sorted ``order_col`` over distinct values (P20).

    Distributed: a range-partitioned sort, per-partition counts (one row per
    partition reaches the driver), then a per-partition counter offset by the
    counts of earlier partitions. No single-partition window over the keys.
    The sorted keys are checkpointed so both passes see the same partitions.
    """
    keys = df.select(order_col).distinct().orderBy(order_col)
    keys = reliable_checkpoint(keys.withColumn("_pid", F.spark_partition_id()))
    counts = {r["_pid"]: r["n"] for r in keys.groupBy("_pid").agg(F.count("*").alias("n")).collect()}
    offsets, run = {}, 0
    for pid in sorted(counts):
        offsets[pid] = run
        run += counts[pid]
    field = df.schema[order_col]
    schema = T.StructType([field, T.StructField(out_col, T.LongType(), False)])

    def number(batches):
        seen = {}
        for pdf in batches:
            if pdf.empty:
                continue
            pid = int(pdf["_pid"].iloc[0])
            start = offsets.get(pid, 0) + seen.get(pid, 0)
            seen[pid] = seen.get(pid, 0) + len(pdf)
            yield pd.DataFrame({order_col: pdf[order_col].values,
                                out_col: range(start + 1, start + 1 + len(pdf))})

    return keys.mapInPandas(number, schema)
