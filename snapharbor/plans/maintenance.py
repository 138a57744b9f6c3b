"""The metrics mart kept up to date from one snapshot to the next.

Sums and counts per metric key are the state. Between two snapshots only the fuel rows of vehicles
that differ are aggregated, those of the old snapshot to be taken away and those of the new one to
be added. A vehicle counts once in each group it has a row in, so its old and new groups are
found from its own rows alone, and distinct counts stay exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapharbor.functions.text import round_half_away
from snapharbor.operators.joins import keep_ids
from snapharbor.operators.quality import differing_buckets
from snapharbor.plans.models import METRIC_KEYS
from snapharbor.session import materialize

# Measures and how many decimals of them are summed: sums that are added to and taken from must be exact.
MEASURES = {"co2_combined_g_km": "co2", "net_max_power_kw": "power"}
SUMMED = "decimal(38,6)"
COUNTS = ["vehicles", *[f"{m}_{kind}" for m in MEASURES.values() for kind in ("sum", "count")]]


def metric_state(fuel_rows: DataFrame, vehicle: str) -> DataFrame:
    """One row per metric key: distinct vehicles, and sum and count of each measure."""
    parts: list[Column] = [F.countDistinct(vehicle).alias("vehicles")]
    for column, name in MEASURES.items():
        value = F.round(F.col(column), 6).cast("decimal(20,6)")
        parts.append(F.coalesce(F.sum(value), F.lit(0)).cast(SUMMED).alias(f"{name}_sum"))
        parts.append(F.count(column).alias(f"{name}_count"))
    return fuel_rows.groupBy(*METRIC_KEYS).agg(*parts)


def changed_vehicles(before: DataFrame, after: DataFrame, vehicle: str) -> DataFrame:
    """Vehicles whose fuel rows differ between two snapshots, in either direction.

    A vehicle is a bucket of its own: its checksums are moved and not its rows.
    """
    columns = [vehicle, *[c for c in METRIC_KEYS if c != vehicle], *MEASURES]
    apart = differing_buckets(before.select(*columns), after.select(*columns), by=vehicle)
    return apart.withColumnRenamed("bucket", vehicle)


def maintained_state(state: DataFrame, before: DataFrame, after: DataFrame, vehicle: str) -> DataFrame:
    """The state of snapshot ``after``, from that of ``before`` and what differs."""
    changed = materialize(changed_vehicles(before, after, vehicle), "changed")
    gone = metric_state(keep_ids(before, changed, vehicle), vehicle)
    come = metric_state(keep_ids(after, changed, vehicle), vehicle)
    minus = [(-F.col(c)).cast(SUMMED if c.endswith("sum") else "bigint").alias(c) for c in COUNTS]
    moved = state.unionByName(come).unionByName(gone.select(*METRIC_KEYS, *minus))
    kinds = [F.sum(c).cast(SUMMED if c.endswith("sum") else "bigint").alias(c) for c in COUNTS]
    return moved.groupBy(*METRIC_KEYS).agg(*kinds).where("vehicles > 0")


def metrics_of_state(state: DataFrame) -> DataFrame:
    """The metrics mart that a state stands for."""

    def mean(name: str) -> Column:
        total = F.col(f"{name}_sum").cast("double")
        return F.when(F.col(f"{name}_count") > 0, total / F.col(f"{name}_count"))

    return state.select(
        *METRIC_KEYS,
        F.col("vehicles").alias("vehicle_count"),
        round_half_away(mean("co2"), 2).alias("avg_reported_co2_combined_g_km"),
        round_half_away(mean("power"), 2).alias("avg_reported_net_max_power_kw"),
    )
