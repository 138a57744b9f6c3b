"""Canonical page payloads, their digests, and the ledger of seen payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapharbor.operators.joins import drop_ids, join_reduced
from snapharbor.operators.paging import global_position
from snapharbor.spec import check_page_size


def canonical_json(fields: list[str]) -> Column:
    """One row as JSON: keys in name order, no spaces, NULL fields left out."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(fields)]))


def detail_pages(
    rows: DataFrame, batch_col: str, order: list[str], page_size: int
) -> DataFrame:
    """Cut the detail rows of each id batch into pages of at most ``page_size`` rows.

    Positions are global and every batch is one contiguous range of them, so a batch
    inflated by a hot id becomes many pages in many tasks.
    """
    check_page_size(page_size)
    placed = global_position(
        rows, F.col(batch_col), *[F.col(c).asc_nulls_first() for c in order], name="_pos"
    )
    starts = placed.groupBy(batch_col).agg(F.min("_pos").alias("_start"))
    offset = F.col("_pos") - F.col("_start")
    return (
        join_reduced(placed, starts, [batch_col])
        .withColumn("chunk", F.floor(offset / page_size))
        .withColumn("pos", offset % page_size)
        .drop("_pos", "_start")
    )


def page_digest(
    rows: DataFrame, page_cols: list[str], pos_col: str, fields: list[str]
) -> DataFrame:
    """Payload text, SHA-256 and row count of each page.

    Pages hold at most the checked page size, which bounds the collected list.
    """
    line = F.struct(F.col(pos_col).alias("pos"), canonical_json(fields).alias("json"))
    pages = rows.groupBy(*page_cols).agg(F.array_sort(F.collect_list(line)).alias("_lines"))
    payload = F.concat(F.lit("["), F.concat_ws(",", F.col("_lines.json")), F.lit("]"))
    return pages.select(
        *page_cols, payload.alias("payload"), F.size("_lines").alias("row_count")
    ).select(*page_cols, "row_count", F.sha2("payload", 256).alias("payload_sha256"), "payload")


def ledger_insert(
    ledger: DataFrame, incoming: DataFrame, order: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Add unseen (dataset, digest) pairs and flag every incoming payload.

    ``incoming`` carries the ledger columns of each arriving payload plus ``order``.
    The first arrival of an unseen pair enters the ledger; every other arrival is a
    duplicate. First arrivals come from a minimum over a struct, so a digest repeated
    very often is reduced before the shuffle.
    """
    key = ["dataset", "payload_sha256"]
    rest = [c for c in ledger.columns if c not in key]
    arrival = F.struct(*[F.col(c) for c in order])
    first = incoming.groupBy(*key).agg(
        F.min(F.struct(arrival.alias("arrival"), *[F.col(c) for c in rest])).alias("_first")
    )
    unseen = drop_ids(first, ledger, key)
    added = unseen.select(
        *[F.col(c) if c in key else F.col(f"_first.{c}").alias(c) for c in ledger.columns]
    )
    opening = unseen.select(*key, F.col("_first.arrival").alias("_opening"))
    flagged = (
        join_reduced(incoming, opening, key, "left")
        .withColumn(
            "duplicate", F.coalesce(F.col("_opening") != arrival, F.lit(True))
        )
        .drop("_opening")
    )
    return ledger.unionByName(added), flagged


def duplicate_payload_count(flagged: DataFrame, run_col: str) -> DataFrame:
    return flagged.groupBy(run_col).agg(
        F.sum(F.col("duplicate").cast("long")).alias("duplicate_payloads")
    )
