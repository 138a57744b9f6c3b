"""Report aggregates and example queries over the published marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapharbor.operators.topn import top_rows, topn_with_ties
from snapharbor.plans.measures import measure
from snapharbor.session import materialize


def vehicles_by(overview: DataFrame, *by: str) -> DataFrame:
    return overview.groupBy(*by).agg(F.sum(F.col("vehicle_count").cast("long")).alias("vehicles"))


def top_brands(overview: DataFrame, n: int = 10) -> DataFrame:
    """Brands among the ``n`` largest, ties kept; a brand filter, not a row limit."""
    return topn_with_ties(vehicles_by(overview, "brand"), "vehicles", n)


def brand_by_powertrain(overview: DataFrame, n: int = 15) -> DataFrame:
    """Vehicles per top brand and powertrain.

    The finer groups are computed once; brand totals are sums of those small groups.
    """
    cells = materialize(vehicles_by(overview, "brand", "powertrain_category"), "cells")
    brands = cells.groupBy("brand").agg(F.sum("vehicles").alias("total"))
    top = topn_with_ties(brands, "total", n)
    same = F.col("c.brand").eqNullSafe(F.col("t.brand"))
    return cells.alias("c").join(top.alias("t"), same, "left_semi")


def model_matrix(overview: DataFrame) -> DataFrame:
    return measure(
        overview,
        overview,
        ["vehicles", "multi_fuel_share"],
        by=("brand", "model", "vehicle_type"),
        rollup=True,
    )


def fuel_matrix(overview: DataFrame, fuel: DataFrame) -> DataFrame:
    return measure(
        overview,
        fuel,
        ["vehicles_with_fuel", "fuel_records", "co2_coverage", "power_coverage"],
        by=("fuel_type", "hybrid_class"),
        rollup=True,
    )


def fuel_cards(overview: DataFrame, fuel: DataFrame, filters: dict | None = None) -> DataFrame:
    return measure(
        overview,
        fuel,
        [
            "vehicles_with_fuel",
            "fuel_records",
            "avg_co2",
            "avg_power",
            "co2_coverage",
            "power_coverage",
        ],
        filters=filters,
    )


def q_top_brands(overview: DataFrame) -> DataFrame:
    groups = overview.groupBy("brand").agg(
        F.sum(F.col("vehicle_count").cast("long")).alias("ev_vehicle_count")
    )
    return top_rows(
        groups, [F.col("ev_vehicle_count").desc(), F.col("brand").asc_nulls_last()], 10
    )


def q_year_profile(overview: DataFrame) -> DataFrame:
    rows = overview.where(F.col("registration_year").isNotNull())
    groups = rows.groupBy("registration_year", "powertrain_category").agg(
        F.sum(F.col("vehicle_count").cast("long")).alias("vehicle_count")
    )
    return groups.orderBy(F.col("registration_year").desc(), F.col("vehicle_count").desc())


def q_metrics_top50(metrics: DataFrame) -> DataFrame:
    """The remaining keys break ties, so the cut is the same on every run."""
    order = [F.col("vehicle_count").desc()] + [
        F.col(c).asc_nulls_last()
        for c in ("brand", "model", "fuel_type", "registration_year", "powertrain_category")
    ]
    return top_rows(metrics, order, 50)


def q_snapshot_grain(snapshot: DataFrame) -> DataFrame:
    return (
        snapshot.groupBy("snapshot_ingestion_id")
        .agg(
            F.count(F.lit(1)).alias("vehicle_snapshot_rows"),
            F.sum("fuel_record_count").alias("reported_fuel_rows"),
        )
        .orderBy(F.col("snapshot_ingestion_id").desc())
    )


# Columns of the run history.
RUN_AUDIT_COLUMNS = [
    "ingestion_id",
    "ingestion_mode",
    "requested_limit",
    "started_at",
    "completed_at",
    "status",
    "page_size",
    "pages_requested",
    "source_rows_received",
    "vehicle_rows",
    "fuel_rows",
    "rejected_rows",
    "duplicate_payloads",
    "active_duration_seconds",
    "wall_clock_elapsed_seconds",
    "processed_rows_per_second",
    "checkpoint_status",
    "resumed",
    "resume_count",
]


def q_run_audit(runs: DataFrame) -> DataFrame:
    return runs.select(*RUN_AUDIT_COLUMNS).orderBy(F.col("started_at").desc())
