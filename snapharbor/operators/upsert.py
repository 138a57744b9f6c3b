"""Keyed upsert without a table format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from snapharbor.operators.joins import drop_ids, join_reduced
from snapharbor.session import materialize


class EmptySnapshotError(ValueError):
    """A page or snapshot left no usable vehicle row."""


def upsert_by_key(
    target: DataFrame, incoming: DataFrame, keys: list[str], dedupe: str = "none",
    order: list[Column] | None = None,
) -> DataFrame:
    """Delete target rows whose key is incoming, then add every incoming row.

    Duplicates inside ``incoming`` are kept, as a delete-then-insert does;
    ``dedupe="last"`` keeps the row that sorts last by ``order``.
    """
    if dedupe == "last":
        if not order:
            raise ValueError("dedupe='last' needs an order")
        incoming = keep_last(incoming, keys, order)
    elif dedupe != "none":
        raise ValueError("dedupe must be 'none' or 'last'")
    return drop_ids(target, incoming, keys).unionByName(incoming)


def keep_last(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the last in ``order``, NULL sorting first.

    Spark applies a ``row_number`` limit before the shuffle as well as after it, so
    the copies of a hot key are reduced to one per task where they are read. Columns
    outside ``keys`` and ``order`` are read only if the caller uses them.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*[o.desc_nulls_last() for o in order])
    ranked = df.withColumn("_rank", F.row_number().over(newest_first))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def resolve_latest(log: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Current rows of an append-only log of upserts.

    Applying each version as delete-by-key then insert leaves, for every key, exactly
    the rows of the last version that holds it. Appending versions and resolving
    once costs one pass, where rewriting the table per version costs one each.
    """
    newest = log.groupBy(*keys).agg(F.max(version).alias("_newest"))
    # A NULL key equals nothing, so such rows find no newest version and stay.
    found = join_reduced(log, newest, keys, "left")
    superseded = F.coalesce(F.col(version) < F.col("_newest"), F.lit(False))
    return found.where(~superseded).select(*[c for c in log.columns if c != version])


def latest_rows(log: DataFrame, keys: list[str], version: str) -> DataFrame:
    """``resolve_latest`` for a stored log in which few keys have several versions.

    A first pass looks for hashes of keys that have more than one version, and only rows with
    such a hash are resolved; the others are already current and do not move.
    """
    hashed = F.xxhash64(*keys)
    spans = log.groupBy(hashed.alias("_hash")).agg(F.min(version).alias("a"), F.max(version).alias("b"))
    several = materialize(spans.where("a < b").select("_hash"), "several-versions")
    if several.isEmpty():
        return log.drop(version)
    tagged = log.withColumn("_hash", hashed)
    apart = resolve_latest(tagged.join(several, "_hash", "left_semi").drop("_hash"), keys, version)
    rest = tagged.join(several, "_hash", "left_anti").drop("_hash", version)
    return rest.unionByName(apart)


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Fail when nothing is left; reads at most one row."""
    if df.isEmpty():
        raise EmptySnapshotError(message)
    return df
