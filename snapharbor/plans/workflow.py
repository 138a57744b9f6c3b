"""End-to-end jobs: raw rows or staging to a published set."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from snapharbor.operators.gates import schema_problems, staging_gate
from snapharbor.operators.matching import complete_ids, complete_rows
from snapharbor.operators.paging import snapshot_cap
from snapharbor.operators.quality import DataQualityError, raise_on_violations
from snapharbor.operators.upsert import require_rows
from snapharbor.plans.contracts import model_checks
from snapharbor.plans.models import build_models
from snapharbor.plans.normalize import normalize_fuels, normalize_vehicles
from snapharbor.session import configure, scratch_path
from snapharbor.sources.publication import publish_set
from snapharbor.sources.tables import output_inventory, scan_staging, write_staging
from snapharbor.spec import PUBLISHED_RELATIONS, SnapshotSpec


@dataclass(frozen=True)
class SnapshotResult:
    quality_checks: dict[str, int]
    relation_rows: dict[str, int]
    paths: list[str]


def stage_snapshot(
    anchors: DataFrame,
    vehicles: DataFrame,
    fuels: DataFrame,
    spec: SnapshotSpec,
    ingestion_id: str,
    limit: int | None = None,
) -> dict[str, DataFrame]:
    """Complete, capped and normalised rows of one snapshot."""
    accepted = complete_ids(anchors, vehicles, fuels, spec.raw_id)
    accepted = snapshot_cap(accepted, spec.raw_id, limit)
    return {
        "vehicles": normalize_vehicles(
            complete_rows(vehicles, accepted, spec.raw_id), spec, ingestion_id
        ),
        "fuels": normalize_fuels(
            complete_rows(fuels, accepted, spec.raw_id), spec, ingestion_id
        ),
    }


def run_snapshot(
    spark: SparkSession,
    staged: dict[str, DataFrame],
    runs: DataFrame,
    publish_root: str,
    spec: SnapshotSpec,
) -> SnapshotResult:
    """Replace staging with this snapshot, then build, check and publish."""
    configure(spark, steps=True)
    root = scratch_path(spark, "staging")
    write_staging({**staged, "ingestion_runs": runs}, root)
    return transform_only(spark, scan_staging(spark, root), publish_root, spec)


def transform_only(
    spark: SparkSession,
    staging: dict[str, DataFrame],
    publish_root: str,
    spec: SnapshotSpec,
) -> SnapshotResult:
    """Gate existing staging tables, build and test the models, publish the set.

    Whatever fails, the set published before stays in place.
    """
    configure(spark, steps=True)
    problems = schema_problems(staging)
    if problems:
        raise DataQualityError("staging schema is incompatible: " + "; ".join(problems))
    require_rows(staging["vehicles"], "the snapshot holds no vehicle")
    checks = raise_on_violations(staging_gate(staging["vehicles"], staging["fuels"]))
    models = build_models(staging, spec, write=True)

    def test_models(written: dict[str, DataFrame]) -> None:
        checks.update(raise_on_violations(model_checks({**models, **written}, spec)))

    paths = publish_set(models, publish_root, check=test_models)
    published = {
        r: spark.read.parquet(p) for r, p in zip(sorted(PUBLISHED_RELATIONS), paths)
    }
    inventory = output_inventory(published, PUBLISHED_RELATIONS)
    rows = {r["relation"]: r["rows"] for r in inventory.collect()}
    return SnapshotResult(checks, rows, paths)
