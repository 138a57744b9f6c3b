"""Declared data tests of the models, and the singular tests that span models."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapharbor.functions.keys import packed
from snapharbor.operators import gates, quality
from snapharbor.plans import models as m
from snapharbor.spec import PLAIN_ID_COLUMNS, SnapshotSpec, VEHICLE_SPEC

CATEGORIES = VEHICLE_SPEC.categories


@dataclass(frozen=True)
class Contract:
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    unique_expr: dict[str, Callable[[], Column]] = field(default_factory=dict)
    accepted: dict[str, list] = field(default_factory=dict)
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)


def joined(separator: str, *columns: str, null: str | None = None) -> Column:
    """Columns as one text; a NULL becomes ``null``, or makes the whole text NULL."""
    parts = []
    for name in columns:
        part = F.col(name).cast("string")
        parts += [F.lit(separator), part if null is None else F.coalesce(part, F.lit(null))]
    return F.concat(*parts[1:])


# What each column of each model must satisfy.
CONTRACTS = {
    "stg_vehicles": Contract(
        not_null=("vehicle_id_hash", "ingestion_id"), unique=("vehicle_id_hash",)
    ),
    "stg_fuels": Contract(
        not_null=("vehicle_id_hash", "fuel_sequence", "fuel_type", "ingestion_id"),
        unique_expr={
            "vehicle_and_sequence": lambda: F.concat(
                packed(F.col("vehicle_id_hash")), F.concat(F.lit(":"), "fuel_sequence").cast("binary")
            )
        },
        parents={"vehicle_id_hash": ("stg_vehicles", "vehicle_id_hash")},
    ),
    "stg_ingestion_runs": Contract(
        not_null=("ingestion_id", "started_at"), unique=("ingestion_id",)
    ),
    "int_vehicle_fuel_profile": Contract(
        not_null=("vehicle_id_hash", "fuel_record_count", *m.FLAGS, "powertrain_category"),
        unique=("vehicle_id_hash",),
        accepted={"powertrain_category": CATEGORIES},
    ),
    "int_snapshot_context": Contract(not_null=("ingestion_id",), unique=("ingestion_id",)),
    "dim_vehicle": Contract(not_null=("vehicle_key",), unique=("vehicle_key",)),
    "dim_vehicle_model": Contract(
        not_null=("vehicle_model_key",), unique=("vehicle_model_key",)
    ),
    "dim_registration_date": Contract(
        not_null=(
            "registration_date_key",
            "registration_date",
            "registration_year",
            "registration_month",
            "registration_quarter",
        ),
        unique=("registration_date_key", "registration_date"),
        accepted={"registration_quarter": [1, 2, 3, 4]},
    ),
    "dim_powertrain": Contract(
        not_null=("powertrain_key", "powertrain_category", *m.FLAGS),
        unique=("powertrain_key",),
        accepted={"powertrain_category": CATEGORIES},
    ),
    "fact_vehicle_snapshot": Contract(
        not_null=(
            "vehicle_snapshot_key",
            "vehicle_key",
            "vehicle_model_key",
            "powertrain_key",
            "snapshot_ingestion_id",
            "fuel_record_count",
            "vehicle_count",
        ),
        unique=("vehicle_snapshot_key",),
        accepted={"vehicle_count": [1]},
        parents={
            "vehicle_key": ("dim_vehicle", "vehicle_key"),
            "vehicle_model_key": ("dim_vehicle_model", "vehicle_model_key"),
            "registration_date_key": ("dim_registration_date", "registration_date_key"),
            "powertrain_key": ("dim_powertrain", "powertrain_key"),
        },
    ),
    "fact_vehicle_fuel": Contract(
        not_null=(
            "vehicle_fuel_fact_key",
            "vehicle_snapshot_key",
            "vehicle_key",
            "snapshot_ingestion_id",
            "fuel_sequence",
            "fuel_type",
        ),
        unique=("vehicle_fuel_fact_key",),
        parents={
            "vehicle_snapshot_key": ("fact_vehicle_snapshot", "vehicle_snapshot_key"),
            "vehicle_key": ("dim_vehicle", "vehicle_key"),
        },
    ),
    "mart_ev_overview": Contract(
        not_null=(
            "vehicle_snapshot_key",
            "snapshot_ingestion_id",
            "vehicle_key",
            "powertrain_category",
        ),
        unique=("vehicle_snapshot_key",),
        accepted={"powertrain_category": CATEGORIES},
    ),
    "mart_ev_metrics": Contract(
        not_null=("fuel_type", "powertrain_category", "vehicle_count"),
        unique_expr={"metric_keys": lambda: joined("|", *m.METRIC_KEYS, null="<null>")},
    ),
}


def row_checks(df: DataFrame, model: str, contract: Contract) -> DataFrame:
    """Not-null and accepted-value counts of one model, all in one scan."""
    bad = {f"not_null:{model}.{c}": F.col(c).isNull() for c in contract.not_null}
    for column, values in contract.accepted.items():
        bad[f"accepted_values:{model}.{column}"] = ~F.col(column).isin(*values)
    totals = [F.count(F.when(test, 1)).alias(f"c{i}") for i, test in enumerate(bad.values())]
    cells = [
        F.struct(F.lit(name).alias("check"), F.col(f"c{i}").alias("violations"))
        for i, name in enumerate(bad)
    ]
    return df.agg(*totals).select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def contract_checks(
    models: dict[str, DataFrame], contracts: dict[str, Contract] | None = None
) -> DataFrame:
    """(check, violations) of every declared test."""
    parts, keyed, unique = [], {}, {}
    for model, contract in (contracts or CONTRACTS).items():
        df = models[model]
        if contract.not_null or contract.accepted:
            parts.append(row_checks(df, model, contract))
        for column in contract.unique:
            unique[f"unique:{model}.{column}"] = (df, F.col(column))
        for name, expr in contract.unique_expr.items():
            unique[f"unique:{model}.{name}"] = (df, expr())
        for column, (parent, parent_column) in contract.parents.items():
            keyed[f"relationships:{model}.{column}"] = quality.dq_relationship(
                df, column, models[parent], parent_column
            )
    if unique:
        parts.append(quality.run_unique_tests(unique))
    if keyed:
        parts.append(quality.run_tests(keyed))
    return reduce(DataFrame.unionByName, parts)


def grain_pairs(models: dict[str, DataFrame]) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Expected and actual rows of the dimensions and the overview mart."""
    vehicles, profile = models["stg_vehicles"], models["int_vehicle_fuel_profile"]
    dates = vehicles.where(F.col("registration_date").isNotNull())
    expected = {
        "dim_vehicle": vehicles,
        "dim_registration_date": dates.select("registration_date").distinct(),
        "dim_vehicle_model": vehicles.select("brand", "model", "vehicle_type").distinct(),
        "dim_powertrain": profile.select("powertrain_category", *m.FLAGS).distinct(),
        "mart_ev_overview": models["fact_vehicle_snapshot"],
    }
    return {name: (df, models[name]) for name, df in expected.items()}


def nonnegative_measures(models: dict[str, DataFrame]) -> DataFrame:
    """The label of each measure value below its bound."""
    snapshot = quality.dq_below(
        models["fact_vehicle_snapshot"],
        {"fact_vehicle_snapshot.fuel_record_count": (F.col("fuel_record_count"), 1)},
    )
    fuel = quality.dq_below(
        models["fact_vehicle_fuel"],
        {
            f"fact_vehicle_fuel.{c}": (F.col(c), 0)
            for c in ("co2_combined_g_km", "net_max_power_kw")
        },
    )
    metrics = quality.dq_below(
        models["mart_ev_metrics"], {"mart_ev_metrics.vehicle_count": (F.col("vehicle_count"), 1)}
    )
    return snapshot.unionByName(fuel).unionByName(metrics)


def singular_checks(models: dict[str, DataFrame], spec: SnapshotSpec) -> DataFrame:
    """(check, violations) of the tests that span models."""
    profile = models["int_vehicle_fuel_profile"]
    tests = {
        "grain_reconcile": quality.count_mismatch(grain_pairs(models)),
        "fact_fuel_rowcount": quality.count_mismatch(
            {"fact_vehicle_fuel": (models["stg_fuels"], models["fact_vehicle_fuel"])}
        ),
        "fact_snapshot_rowcount": quality.count_mismatch(
            {"fact_vehicle_snapshot": (models["stg_vehicles"], models["fact_vehicle_snapshot"])}
        ),
        "mart_recompute_diff": quality.multiset_diff(
            m.star_metrics(models), models["mart_ev_metrics"]
        ),
        "nonnegative_measures": nonnegative_measures(models),
        "classification": gates.classification_violations(profile, m.powertrain_category(spec)),
        "date_range": quality.dq_date_range(
            models["dim_registration_date"], "registration_date"
        ),
    }
    exposed = len(gates.banned_columns(models, PLAIN_ID_COLUMNS))
    plain = models["dim_powertrain"].agg(F.count(F.lit(1))).select(
        F.lit("no_plaintext_columns").alias("check"),
        F.lit(exposed).cast("long").alias("violations"),
    )
    return quality.run_tests(tests).unionByName(plain)


def model_checks(models: dict[str, DataFrame], spec: SnapshotSpec) -> DataFrame:
    return contract_checks(models).unionByName(singular_checks(models, spec))
