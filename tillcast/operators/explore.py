"""Exploration aggregates: profiles, resamples, chart data, ACF.

Every profile is one grouped aggregation (partial aggregation before the
shuffle); "one row per column" profiles are a single ``agg`` then
``unpivot``, so the table is scanned once whatever the column count.
"""

from __future__ import annotations

import math

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions import dates as D
from tillcast.session import reliable_checkpoint

QUARTILES = [0.25, 0.5, 0.75]
Z95 = 1.96


def resample(df: DataFrame, date: str, rule: str, aggs: Sequence[Column], keys: Sequence[str] = ()) -> DataFrame:
    """Calendar resample: ``rule`` in week (ending Sunday), month (end), year (end)."""
    key = {"week": D.week_end, "month": D.month_end, "year": D.year_end}[rule](date)
    return df.groupBy(*keys, key.alias(date)).agg(*aggs)


def null_profile(df: DataFrame) -> DataFrame:
    """Null count per column, kept when > 0."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return (counts.unpivot([], df.columns, "column", "n_null")
            .filter(F.col("n_null") > 0))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std, min, exact interpolated quartiles, max per column.

    Exact ``percentile`` (not ``summary()``'s approximate one). Rows are
    counted by value first, in parallel; every statistic then comes from the
    (value, count) rows.
    """
    parts = []
    for c in cols:
        x, w = F.col(c), F.col("_n")
        q = F.percentile(x, F.array(*[F.lit(p) for p in QUARTILES]), w)
        n, mean = F.sum(w), F.sum(x * w) / F.sum(w)
        counts = df.where(x.isNotNull()).groupBy(c).agg(F.count("*").alias("_n"))
        spread = F.sqrt(F.greatest(F.sum(x * x * w) - F.sum(x * w) * mean, F.lit(0.0)) / F.nullif(n - 1, F.lit(0)))
        parts.append(counts.agg(
            F.lit(c).alias("column"), F.coalesce(n, F.lit(0)).alias("count"), mean.alias("mean"),
            spread.alias("std"), F.min(x).cast("double").alias("min"),
            q[0].alias("q25"), q[1].alias("q50"), q[2].alias("q75"), F.max(x).cast("double").alias("max")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def schema_profile(df: DataFrame) -> DataFrame:
    """Column name, type and non-null count."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    long = counts.unpivot([], df.columns, "column", "non_null")
    tcol = F.create_map(*[x for k, v in types.items() for x in (F.lit(k), F.lit(v))])
    return long.select("column", tcol[F.col("column")].alias("type"), "non_null")


def mean_ci(df: DataFrame, by: Sequence[str], y: str) -> DataFrame:
    """Mean with a normal 95 % interval, mean +- 1.96 sd / sqrt(n)."""
    m, s, n = F.avg(y), F.stddev_samp(y), F.count(y)
    half = F.lit(Z95) * s / F.sqrt(n)
    return df.groupBy(*by).agg(m.alias("mean"), (m - half).alias("ci_low"), (m + half).alias("ci_high"),
                               n.alias("n"))


def auto_histogram(df: DataFrame, x: str) -> DataFrame:
    """Histogram with automatic bin width.

    Bin width is the smaller of the Freedman-Diaconis width
    (2 IQR n^(-1/3)) and the Sturges width (range / (log2 n + 1)), as numpy's
    "auto" rule; the range is then cut into equal bins. The statistics come
    from one aggregate (a scalar subquery), then a bucket id per row and a
    count per bucket.
    """
    df = reliable_checkpoint(df)  # a small aggregate; the statistics and the counts both read it
    v = F.col(x).cast("double")
    q = F.percentile(v, F.array(F.lit(0.25), F.lit(0.75)))
    stats = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi"), F.count(v).alias("n"),
                   (q[1] - q[0]).alias("iqr"))
    rng = F.col("hi") - F.col("lo")
    sturges = rng / (F.log2(F.col("n")) + 1)
    fd = 2 * F.col("iqr") * F.pow(F.col("n"), -1.0 / 3)
    width = F.when(fd > 0, F.least(fd, sturges)).otherwise(sturges)
    nb = F.when(rng > 0, F.greatest(F.ceil(rng / width), F.lit(1))).otherwise(F.lit(1)).cast("int")
    st = stats.select("lo", "hi", nb.alias("nb")).select(F.struct("lo", "hi", "nb").alias("s")).scalar()
    lo, hi, nbins = st["lo"], st["hi"], st["nb"]
    step = F.when(hi > lo, (hi - lo) / nbins).otherwise(F.lit(1.0))
    b = F.least(F.floor((v - lo) / step), nbins - 1).cast("int")
    counted = df.filter(F.col(x).isNotNull()).groupBy(b.alias("bin")).agg(F.count("*").alias("count"))
    return counted.select("bin", (lo + F.col("bin") * step).alias("bin_low"),
                          (lo + (F.col("bin") + 1) * step).alias("bin_high"), "count")


def acf(series: DataFrame, t: str, y: str, max_lag: int) -> DataFrame:
    """Biased autocorrelation up to ``max_lag`` with the Bartlett 95 % band.

    Pairs (t, t + k) come from an ``explode`` of lags on one side joined to
    the series on ``t + k``: linear in n x K, never all pairs. The series is
    one aggregated row per period (a resampled total), checkpointed once so
    the statistics do not re-derive it, and the final window over the K+1 lag
    rows is tiny.
    """
    series = reliable_checkpoint(series)  # one row per period; read by the statistics and the pairs
    st = series.agg(F.struct(F.avg(y).alias("m"), F.count(y).alias("n"))).scalar()
    mean, n = st["m"], st["n"]
    dev = series.select(F.col(t).alias("t"), (F.col(y) - mean).alias("e"))
    lagged = dev.select("t", "e", F.explode(F.sequence(F.lit(0), F.lit(max_lag))).alias("k"))
    pairs = lagged.join(dev.select(F.col("t").alias("t2"), F.col("e").alias("e2")),
                        F.col("t2") == F.col("t") + F.col("k"))
    num = pairs.groupBy("k").agg(F.sum(F.col("e") * F.col("e2")).alias("s"))
    c0 = dev.agg(F.sum(F.col("e") * F.col("e"))).scalar()
    r = num.select("k", (F.col("s") / c0).alias("acf"))
    w = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    prior = F.coalesce(F.sum(F.when(F.col("k") >= 1, F.col("acf") * F.col("acf"))).over(w), F.lit(0.0))
    var = (F.when(F.col("k") == 0, F.lit(0.0))
           .when(F.col("k") == 1, F.lit(1.0) / n)
           .otherwise((1 + 2 * prior) / n))
    return r.select("k", "acf", (F.lit(Z95) * F.sqrt(var)).alias("band"))


#: Terms of the tabulated Poisson distribution of mean one: beyond 17 it has less than 2^-52.
POISSON_TERMS = 18


def poisson_one() -> list[float]:
    """P(X <= k) of a Poisson distribution of mean one."""
    term, out = math.exp(-1.0), [math.exp(-1.0)]
    for k in range(1, POISSON_TERMS):
        term /= k
        out.append(out[-1] + term)
    return out


def bootstrap_ci(df: DataFrame, by: list[str], y: str, row_key: list[str], replicates: int = 200, seed: int = 0, level: float = 0.95) -> DataFrame:
    """by..., mean, ci_low, ci_high, n: bootstrap interval of the mean (A21), as the charts draw it.

    Every row weighs a Poisson(1) number in each replicate, drawn from a hash
    of ``row_key`` and the replicate, so partial sums merge and no row is
    copied or exploded: a group's state is one sum and one weight for each
    replicate. Null values take no part; replicates of weight zero neither.
    """
    cdf = poisson_one()
    key = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in row_key])

    def weight(b):
        u = F.conv(F.substring(F.md5(F.concat_ws("|", key, b.cast("string"))), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))
        return F.size(F.filter(F.array(*map(F.lit, cdf)), lambda c: c <= u))

    rows = df.where(F.col(y).isNotNull()).select(*by, F.col(y).cast("double").alias("_y"), F.transform(F.sequence(F.lit(1), F.lit(replicates)), weight).alias("_w"))
    state = rows.groupBy(*by).agg(
        F.avg("_y").alias("mean"), F.count("*").alias("n"),
        F.array(*[F.sum(F.get("_w", F.lit(b)) * F.col("_y")) for b in range(replicates)]).alias("_s"),
        F.array(*[F.sum(F.get("_w", F.lit(b))) for b in range(replicates)]).alias("_k"))
    means = F.filter(F.zip_with("_s", "_k", lambda a, k: F.when(k > 0, a / k)), lambda m: m.isNotNull())
    sorted_ = state.withColumn("_m", F.sort_array(means))

    def quantile(q):
        at = F.lit(q) * (F.size("_m") - 1)
        low = F.floor(at).cast("int")
        a, b = F.get("_m", low), F.get("_m", F.least(low + 1, F.size("_m") - 1))
        return a + (b - a) * (at - low)
    tail = (1 - level) / 2
    return sorted_.select(*by, "mean", quantile(tail).alias("ci_low"), quantile(1 - tail).alias("ci_high"), "n")
