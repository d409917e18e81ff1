"""Whole series for per-series models, streamed in bounded batches.

Rows are hash-partitioned by series and sorted by day, so a series is a run of
neighbouring rows of one partition (at most one row a day: a series that holds
a third of all sales is as long as any other). Tasks read the rows in Arrow
batches and hold at most ``size`` series at a time, which the models work on
as one array; nothing is collected into one row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.session import ship_package

#: Series of a batch.
BATCH = 64


def runs(frames: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """The rows of one series after another, from frames sorted by ``key``."""
    held: list[pd.DataFrame] = []
    for pdf in frames:
        if pdf.empty:
            continue
        codes = pdf[key].ne(pdf[key].shift()).to_numpy()
        codes[0] = not held or held[-1][key].iloc[-1] != pdf[key].iloc[0]
        cuts = np.flatnonzero(codes)
        for a, b in zip([0, *cuts], [*cuts, len(pdf)], strict=True):
            if b > a:
                if codes[a] and held:
                    yield pd.concat(held, ignore_index=True)
                    held = []
                held.append(pdf.iloc[a:b])
    if held:
        yield pd.concat(held, ignore_index=True)


def batches(frames: Iterator[pd.DataFrame], key: str, size: int) -> Iterator[list[pd.DataFrame]]:
    """Lists of at most ``size`` series."""
    held: list[pd.DataFrame] = []
    for run in runs(frames, key):
        held.append(run)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def forecast_by_batch(rows: DataFrame, key: str, date: str, name: str, model: Callable[[list[pd.DataFrame]], Iterator[tuple]],
                      extra: Sequence[T.StructField] = (), size: int = BATCH) -> DataFrame:
    """key, date, model, mean (and ``extra``): ``model`` turns a list of series, each a frame in date order, into
    tuples (key value, dates, means, extra values). Rows without a key belong to no series and are left out."""
    ship_package(rows.sparkSession)
    schema = T.StructType([rows.schema[key], T.StructField("date", T.DateType()), T.StructField("model", T.StringType()),
                           T.StructField("mean", T.DoubleType()), *extra])
    names = [f.name for f in extra]

    def run(frames):
        for some in batches(frames, key, size):
            out = [pd.DataFrame({key: k, "date": dates, "model": name, "mean": mean, **dict(zip(names, values, strict=True))})
                   for k, dates, mean, values in model(some)]
            if out:
                yield pd.concat(out, ignore_index=True)

    return rows.where(F.col(key).isNotNull()).repartition(key).sortWithinPartitions(key, date).mapInPandas(run, schema)


def days_after(last, h: int) -> list:
    """The ``h`` days after ``last``."""
    return [(pd.Timestamp(last) + pd.Timedelta(days=t)).date() for t in range(1, h + 1)]
