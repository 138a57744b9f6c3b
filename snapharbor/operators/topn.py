"""Top-N by a measure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapharbor.session import materialize


def topn_with_ties(groups: DataFrame, measure: str, n: int) -> DataFrame:
    """Groups whose measure is among the ``n`` largest, ties kept.

    The ``n``-th largest value is the threshold: a top-k per task and one value to
    compare with, instead of ranking all groups in one window partition. The groups are stored
    first, since both the threshold and the result read them.
    """
    if n < 1:
        raise ValueError("n must be positive")
    scored = materialize(groups.where(F.col(measure).isNotNull()), "groups")
    largest = scored.select(measure).orderBy(F.col(measure).desc()).limit(n)
    threshold = largest.agg(F.min(measure).alias("threshold"))
    return scored.where(F.col(measure) >= threshold.scalar())


def top_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows in an order that states where NULL goes."""
    return df.orderBy(*order).limit(n)
