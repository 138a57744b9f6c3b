"""Joins with lookups and with sides that were reduced by the join key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapharbor.session import materialize


def lookup_join(
    facts: DataFrame, lookup: DataFrame, on: str | list[str], how: str = "left"
) -> DataFrame:
    """Join facts with a lookup that is normally tiny.

    The lookup is stored first. Spark then knows its size when it plans the join: within
    its own threshold it is broadcast, so the facts do not move and a hot lookup key costs
    nothing; beyond it this is an equi-join, whose hot partitions AQE splits.
    """
    return facts.join(materialize(lookup, "lookup"), on, how)


def common_types(rows: DataFrame, reduced: DataFrame, keys: list[str]) -> dict[str, str]:
    """The type in which Spark compares each key that the two sides store differently.

    Text against anything else is refused: which side is converted would decide the result.
    """
    left, right = dict(rows.dtypes), dict(reduced.dtypes)
    found = {}
    for key in keys:
        pair = (left[key], right[key])
        if pair[0] == pair[1]:
            continue
        if "string" in pair:
            raise TypeError(f"join key {key} is {pair[0]} on one side and {pair[1]} on the other")
        both = [F.lit(None).cast(t) for t in pair]
        found[key] = rows.sparkSession.range(0).select(F.coalesce(*both)).dtypes[0][1]
    return found


def join_reduced(
    rows: DataFrame, reduced: DataFrame, keys: list[str], how: str = "inner"
) -> DataFrame:
    """Join rows, whose keys may be hot, with a side that was aggregated by those keys.

    Spark would join on the partitioning the aggregate left behind, and AQE cannot
    split such a join. The second key is a function of the first ones, taken in the type
    in which they are compared: it changes no result, but both sides are now shuffled for
    the join, so a hot key is split. The price is one more exchange of the reduced side.
    """
    types = common_types(rows, reduced, keys)
    spread = F.xxhash64(*[F.col(k).cast(types[k]) if k in types else F.col(k) for k in keys])
    return (
        rows.withColumn("_spread", spread)
        .join(reduced.withColumn("_spread", spread), [*keys, "_spread"], how)
        .drop("_spread")
    )


def keep_ids(df: DataFrame, ids: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``ids``.

    The ids are reduced to distinct values first: that aggregates before the
    shuffle, so a key repeated many times there never lands whole in one task.
    """
    keys = [key] if isinstance(key, str) else key
    return join_reduced(df, ids.select(*keys).distinct(), keys, "left_semi")


def drop_ids(df: DataFrame, ids: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``ids`` (a NULL key never occurs)."""
    keys = [key] if isinstance(key, str) else key
    return join_reduced(df, ids.select(*keys).distinct(), keys, "left_anti")
