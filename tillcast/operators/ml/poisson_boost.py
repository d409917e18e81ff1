"""Leaf values of boosting with Poisson loss and log link (F15), as a grouped aggregation.

``leafwise`` takes the same values from its histograms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.operators.ml.leafwise import LABEL_FLOOR


def leaf_values(df: DataFrame, leaf: str, y: str, margin: Column) -> DataFrame:
    """Newton leaf value for Poisson deviance: log(sum y / sum exp(F)) per leaf."""
    return df.groupBy(leaf).agg(
        F.log(F.greatest(F.sum(y), F.lit(LABEL_FLOOR)) / F.sum(F.exp(margin))).alias("gamma"))
