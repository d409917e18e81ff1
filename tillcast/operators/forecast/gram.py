"""Per-series least squares from sufficient statistics.

A regression per series needs only its Gram block: X'X (k x k), X'y and
y'y. These are plain sums, so every series is reduced in *one* grouped
aggregation with partial aggregation before the shuffle; a hot series is
pre-summed on every map task and never materialised in one place. The
k x k solves then run in Arrow batches (``mapInPandas``) over one small row
per series - Python never sees the facts, only k(k+3)/2 + 2 numbers per
series.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTERCEPT = "_one"


def _design(xcols: Sequence[str], intercept: bool) -> list[Column]:
    cols = [F.col(c).cast("double") for c in xcols]
    return ([F.lit(1.0)] if intercept else []) + cols


def gram_sums(df: DataFrame, key: str | Sequence[str], xcols: Sequence[str], y: str,
              intercept: bool = True) -> DataFrame:
    """key, xtx (packed upper triangle), xty, yty, n — one aggregation."""
    keys = [key] if isinstance(key, str) else list(key)
    X = _design(xcols, intercept)
    yy = F.col(y).cast("double")
    k = len(X)
    tri = [F.sum(X[i] * X[j]) for i in range(k) for j in range(i, k)]
    return df.groupBy(*keys).agg(
        F.array(*tri).alias("xtx"),
        F.array(*[F.sum(X[i] * yy) for i in range(k)]).alias("xty"),
        F.sum(yy * yy).alias("yty"),
        F.count("*").alias("n"),
    )


def cross_sums(df: DataFrame, key: str, xcols: Sequence[str], y: str, *more: Column) -> DataFrame:
    """key, xty, yty, n (with intercept) and ``more`` aggregates: the part of ``gram_sums`` that differs between series with one design."""
    yy = F.col(y).cast("double")
    return df.groupBy(key).agg(F.array(*[F.sum(x * yy) for x in _design(xcols, True)]).alias("xty"),
                               F.sum(yy * yy).alias("yty"), F.count("*").alias("n"), *more)


def unpack(tri: np.ndarray, k: int) -> np.ndarray:
    """Packed upper triangles (B, k(k+1)/2) -> symmetric (B, k, k)."""
    iu = np.triu_indices(k)
    m = np.zeros((tri.shape[0], k, k))
    m[:, iu[0], iu[1]] = tri
    m[:, iu[1], iu[0]] = tri
    return m


def solve_batch(xtx: np.ndarray, xty: np.ndarray, ridge: float = 0.0) -> np.ndarray:
    """Minimum-norm (pseudo-inverse) solution per series; optional ridge
    scaled by the trace so collinear or constant regressors never fail."""
    k = xtx.shape[-1]
    if ridge > 0:
        lam = ridge * np.trace(xtx, axis1=1, axis2=2) / k
        xtx = xtx + lam[:, None, None] * np.eye(k)[None]
    return np.einsum("bij,bj->bi", np.linalg.pinv(xtx, rcond=1e-10, hermitian=True), xty)


def ols(sums: DataFrame, key: str | Sequence[str], k: int, ridge: float = 0.0) -> DataFrame:
    """key, beta array<double>, sse, n from ``gram_sums`` output."""
    keys = [key] if isinstance(key, str) else list(key)
    fields = [sums.schema[c] for c in keys]
    schema = T.StructType(fields + [T.StructField("beta", T.ArrayType(T.DoubleType())),
                                    T.StructField("sse", T.DoubleType()), T.StructField("n", T.LongType())])

    def fit(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            xtx = unpack(np.stack(pdf["xtx"].to_numpy()).astype(float), k)
            xty = np.stack(pdf["xty"].to_numpy()).astype(float)
            beta = solve_batch(xtx, xty, ridge)
            sse = (pdf["yty"].to_numpy() - 2 * np.einsum("bi,bi->b", beta, xty)
                   + np.einsum("bi,bij,bj->b", beta, xtx, beta))
            out = pdf[keys].copy()
            out["beta"] = list(beta)
            out["sse"] = np.maximum(sse, 0.0)
            out["n"] = pdf["n"].to_numpy()
            yield out

    return sums.select(*keys, "xtx", "xty", "yty", "n").mapInPandas(fit, schema)


def dot(beta: str, xcols: Sequence[str], intercept: bool = True) -> Column:
    """beta' x as a JVM expression (no Python per row)."""
    X = _design(xcols, intercept)
    acc = None
    for i, x in enumerate(X):
        term = F.col(beta)[i] * x
        acc = term if acc is None else acc + term
    return acc
