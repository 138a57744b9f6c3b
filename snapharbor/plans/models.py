"""The warehouse models, from typed views to marts.

Vehicle-grain models are cut from one wide row per vehicle snapshot that keeps the
natural attributes next to the surrogate keys. The marts therefore need no join back
to the dimensions; :func:`star_overview` does that join for readers who hold only
the published star.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapharbor.functions.keys import date_key, md5_key, packed, unpacked
from snapharbor.functions.text import blank_to_null, round_half_away
from snapharbor.operators.joins import lookup_join
from snapharbor.session import materialize
from snapharbor.spec import SnapshotSpec

METRIC_KEYS = ["fuel_type", "brand", "model", "registration_year", "powertrain_category"]
# Vehicles are joined by their packed hash, which is unpacked where it is part of a result.
SHORT = "_vehicle"
FLAGS = ["has_electric", "has_hydrogen", "has_other_fuel"]
OVERVIEW_COLUMNS = [
    "vehicle_snapshot_key",
    "snapshot_ingestion_id",
    "snapshot_started_at",
    "vehicle_key",
    "brand",
    "model",
    "vehicle_type",
    "primary_colour",
    "secondary_colour",
    "registration_date",
    "registration_year",
    "powertrain_category",
    "has_electric",
    "has_hydrogen",
    "has_other_fuel",
    "fuel_record_count",
    "vehicle_count",
]


# --- typed views -----------------------------------------------------------------


def stg_vehicles(vehicles: DataFrame) -> DataFrame:
    texts = ["brand", "model", "primary_colour", "secondary_colour", "vehicle_type"]
    typed = {c: blank_to_null(F.col(c)) for c in texts}
    typed["registration_date"] = F.col("registration_date").cast("date")
    typed["registration_year"] = F.col("registration_year").cast("int")
    return _retype(vehicles, typed)


def stg_fuels(fuels: DataFrame) -> DataFrame:
    typed = {c: blank_to_null(F.col(c)) for c in ("fuel_type", "emission_code", "hybrid_class")}
    typed["fuel_sequence"] = F.col("fuel_sequence").cast("int")
    typed["co2_combined_g_km"] = F.col("co2_combined_g_km").cast("double")
    typed["net_max_power_kw"] = F.col("net_max_power_kw").cast("double")
    return _retype(fuels, typed)


def _retype(df: DataFrame, typed: dict[str, Column]) -> DataFrame:
    return df.select(
        *[typed.get(c, F.col(c).cast("string")).alias(c) for c in df.columns]
    )


# Columns of the run view and their types.
RUN_VIEW = {
    "ingestion_id": "string",
    "started_at": "timestamp",
    "ingestion_mode": "string",
    "requested_limit": "bigint",
    "page_size": "int",
    "api_requests": "int",
    "source_rows_received": "bigint",
    "matched_vehicles": "bigint",
    "fuel_rows": "bigint",
    "rejected_rows": "bigint",
    "resumed": "boolean",
    "resume_count": "int",
}


def stg_ingestion_runs(runs: DataFrame) -> DataFrame:
    source = {"api_requests": "pages_requested"}
    return runs.select(
        *[F.col(source.get(name, name)).cast(kind).alias(name) for name, kind in RUN_VIEW.items()]
    )


# --- intermediate ----------------------------------------------------------------


def powertrain_category(spec: SnapshotSpec) -> Column:
    """Hydrogen wins; electric alone is battery; electric with another fuel is hybrid."""
    electric, hydrogen, other = (F.col(c) for c in FLAGS)
    return (
        F.when(hydrogen, spec.hydrogen_label)
        .when(electric & ~other, spec.battery_label)
        .when(electric & other, spec.hybrid_label)
    )


def type_profile(fuels: DataFrame, spec: SnapshotSpec, key: str = "vehicle_id_hash") -> DataFrame:
    """One row per vehicle with an electric or hydrogen fuel.

    Three flags and a count, all combined before the shuffle. ``key`` is what vehicles are
    known by: where rows still have a short key, grouping by it is cheaper than by its hash.
    """
    kind = F.lower("fuel_type")
    profile = fuels.groupBy(key).agg(
        F.count(F.lit(1)).alias("fuel_record_count"),
        F.bool_or(kind == spec.electric).alias("has_electric"),
        F.bool_or(kind == spec.hydrogen).alias("has_hydrogen"),
        F.bool_or(~kind.isin(spec.electric, spec.hydrogen)).alias("has_other_fuel"),
    )
    return profile.where(F.col("has_electric") | F.col("has_hydrogen")).select(
        "*", powertrain_category(spec).alias("powertrain_category")
    )


def snapshot_context(vehicles: DataFrame, runs: DataFrame) -> DataFrame:
    """Distinct run context of the ingestions present in staging.

    Ingestion ids are made distinct before the join as well as after it: joining every
    vehicle row first could only repeat rows that the final distinct removes.
    """
    present = vehicles.select("ingestion_id").distinct()
    return present.join(run_context(runs), "ingestion_id", "left").distinct()


def run_context(runs: DataFrame) -> DataFrame:
    """Distinct context of all runs; a lookup for rows that name their run.

    Rows joined with this see exactly what they would see in the context of the
    ingestions present, without a scan to find those ingestions.
    """
    return runs.select(
        "ingestion_id",
        F.col("started_at").alias("snapshot_started_at"),
        "ingestion_mode",
        "requested_limit",
        "page_size",
        "api_requests",
        "source_rows_received",
        "resumed",
        "resume_count",
    ).distinct()


# --- surrogate keys --------------------------------------------------------------


def snapshot_key(spec: SnapshotSpec) -> Column:
    return md5_key(F.col("ingestion_id"), F.col("vehicle_id_hash"), separator=spec.separator)


def fuel_fact_key(spec: SnapshotSpec) -> Column:
    return md5_key(
        F.col("ingestion_id"),
        F.col("vehicle_id_hash"),
        F.col("fuel_sequence"),
        separator=spec.separator,
    )


def vehicle_model_key(spec: SnapshotSpec) -> Column:
    return md5_key(
        F.col("brand"),
        F.col("model"),
        F.col("vehicle_type"),
        separator=spec.separator,
        null_token=spec.null_token,
    )


def powertrain_key(spec: SnapshotSpec) -> Column:
    return md5_key(
        F.col("powertrain_category"), *[F.col(f) for f in FLAGS], separator=spec.separator
    )


# --- dimensions ------------------------------------------------------------------


def dim_vehicle(vehicles: DataFrame) -> DataFrame:
    return vehicles.select(
        F.col("vehicle_id_hash").alias("vehicle_key"), "primary_colour", "secondary_colour"
    )


def dim_vehicle_model(vehicles: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """The key is a function of the attributes, so it is hashed after the distinct."""
    names = ["brand", "model", "vehicle_type"]
    return vehicles.select(*names).distinct().select(
        vehicle_model_key(spec).alias("vehicle_model_key"), *names
    )


def dim_registration_date(vehicles: DataFrame) -> DataFrame:
    day = F.col("registration_date")
    return (
        vehicles.where(day.isNotNull())
        .select("registration_date")
        .distinct()
        .select(
            date_key(day).alias("registration_date_key"),
            "registration_date",
            F.year(day).alias("registration_year"),
            F.month(day).alias("registration_month"),
            F.quarter(day).alias("registration_quarter"),
        )
    )


def dim_powertrain(profile: DataFrame, spec: SnapshotSpec) -> DataFrame:
    names = ["powertrain_category", *FLAGS]
    return profile.select(*names).distinct().select(
        powertrain_key(spec).alias("powertrain_key"), *names
    )


# --- facts -----------------------------------------------------------------------


def wide_snapshot(
    vehicles: DataFrame,
    profile: DataFrame,
    runs: DataFrame | None,
    key: str = "vehicle_id_hash",
) -> DataFrame:
    """One row per classified vehicle with attributes, profile and run start.

    Vehicles and profiles meet on the vehicle key, by which the profile is already
    partitioned; both sides hold one row per vehicle. The run start is looked up, so vehicles do not move to their run
    (which may be the same one for all of them). Without ``runs`` there is no start.
    """
    rows = vehicles.join(profile, key)
    if runs is not None:
        started = run_context(runs).select("ingestion_id", "snapshot_started_at")
        rows = lookup_join(rows, started, "ingestion_id", "left")
    return rows


def _snapshot_columns(spec: SnapshotSpec) -> dict[str, Column]:
    return {
        "vehicle_snapshot_key": snapshot_key(spec),
        "vehicle_key": F.col("vehicle_id_hash"),
        "vehicle_model_key": vehicle_model_key(spec),
        "registration_date_key": date_key(F.col("registration_date")),
        "powertrain_key": powertrain_key(spec),
        "snapshot_ingestion_id": F.col("ingestion_id"),
        "registration_year": F.year("registration_date"),
        "vehicle_count": F.lit(1),
    }


def _cut(wide: DataFrame, columns: list[str], spec: SnapshotSpec) -> DataFrame:
    derived = _snapshot_columns(spec)
    return wide.select(*[derived.get(c, F.col(c)).alias(c) for c in columns])


FACT_SNAPSHOT_COLUMNS = [
    "vehicle_snapshot_key",
    "vehicle_key",
    "vehicle_model_key",
    "registration_date_key",
    "powertrain_key",
    "snapshot_ingestion_id",
    "snapshot_started_at",
    "fuel_record_count",
    "vehicle_count",
]


def fact_vehicle_snapshot(wide: DataFrame, spec: SnapshotSpec) -> DataFrame:
    return _cut(wide, FACT_SNAPSHOT_COLUMNS, spec)


def fact_parents(wide: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """The columns of the snapshot fact that its fuel rows need."""
    return _cut(wide, ["vehicle_key", "snapshot_ingestion_id", "vehicle_snapshot_key"], spec)


def fuel_parents(fuels: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Fuel rows of the vehicles and ingestions in the snapshot fact, with its key."""
    parents = snapshot.select(
        F.col("vehicle_key").alias("vehicle_id_hash"),
        F.col("snapshot_ingestion_id").alias("ingestion_id"),
        "vehicle_snapshot_key",
    )
    return fuels.join(parents, ["vehicle_id_hash", "ingestion_id"])


def fact_vehicle_fuel(fuel_rows: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """The fuel fact, cut from fuel rows that carry their snapshot key."""
    return fuel_rows.select(
        fuel_fact_key(spec).alias("vehicle_fuel_fact_key"),
        "vehicle_snapshot_key",
        F.col("vehicle_id_hash").alias("vehicle_key"),
        F.col("ingestion_id").alias("snapshot_ingestion_id"),
        "fuel_sequence",
        "fuel_type",
        "emission_code",
        "co2_combined_g_km",
        "net_max_power_kw",
        "hybrid_class",
    )


# --- marts -----------------------------------------------------------------------


def mart_ev_overview(wide: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """One row per vehicle snapshot; attributes left out of ``wide`` are left out here."""
    available = {*wide.columns, *_snapshot_columns(spec)}
    return _cut(wide, [c for c in OVERVIEW_COLUMNS if c in available], spec)


def wide_fuels(
    fuels: DataFrame, wide: DataFrame, spec: SnapshotSpec, key: str = "vehicle_id_hash"
) -> DataFrame:
    """Fuel rows with the key and the metric attributes of their vehicle snapshot."""
    names = ["brand", "model", "registration_year", "powertrain_category"]
    names = [n for n in names if n in wide.columns or n in _snapshot_columns(spec)]
    parents = _cut(wide, [key, "ingestion_id", *names], spec)
    rows = fuels.join(parents, [key, "ingestion_id"])
    if key == SHORT:
        rows = rows.withColumn("vehicle_id_hash", unpacked(F.col(SHORT)))
    # vehicle and run are those of the snapshot, so its key need not move
    return rows.withColumn("vehicle_snapshot_key", snapshot_key(spec))


def mart_ev_metrics(fuel_rows: DataFrame, key: str = "vehicle_id_hash") -> DataFrame:
    """Distinct vehicles and mean reported measures per metric key.

    The distinct count reduces to (keys, vehicle) where rows are read; a group that
    holds many of the rows is therefore counted by many tasks.
    """
    return aggregate_metrics(fuel_rows, key)


def aggregate_metrics(rows: DataFrame, vehicle: str) -> DataFrame:
    return rows.groupBy(*METRIC_KEYS).agg(
        F.countDistinct(vehicle).alias("vehicle_count"),
        round_half_away(F.avg("co2_combined_g_km"), 2).alias("avg_reported_co2_combined_g_km"),
        round_half_away(F.avg("net_max_power_kw"), 2).alias("avg_reported_net_max_power_kw"),
    )


def star_rows(snapshot: DataFrame, star: dict[str, DataFrame]) -> DataFrame:
    """Snapshot fact with the attributes of its model, powertrain and date."""
    # A category and three flags: at most eight rows whatever the data.
    powertrain = F.broadcast(star["dim_powertrain"])
    dates = star["dim_registration_date"].select(
        "registration_date_key", "registration_date", "registration_year"
    )
    rows = lookup_join(snapshot, star["dim_vehicle_model"], "vehicle_model_key", "inner")
    rows = rows.join(powertrain, "powertrain_key")
    return lookup_join(rows, dates, "registration_date_key", "left")


def star_overview(star: dict[str, DataFrame]) -> DataFrame:
    """The overview mart, joined back together from the published star."""
    short = packed(F.col("vehicle_key"))
    vehicles = star["dim_vehicle"].withColumn("vehicle_key", short)
    snapshot = star["fact_vehicle_snapshot"].withColumn("vehicle_key", short)
    snapshot = snapshot.withColumn("vehicle_snapshot_key", packed(F.col("vehicle_snapshot_key")))
    # the small dimensions first: their keys then need not move with the rows
    rows = star_rows(snapshot, star).join(vehicles, "vehicle_key")
    for name in ("vehicle_key", "vehicle_snapshot_key"):
        rows = rows.withColumn(name, unpacked(F.col(name)))
    return rows.select(*OVERVIEW_COLUMNS)


def star_metrics(star: dict[str, DataFrame]) -> DataFrame:
    """The metrics mart, recomputed from the published star."""
    short = packed(F.col("vehicle_snapshot_key")).alias("vehicle_snapshot_key")
    fuel = star["fact_vehicle_fuel"].select(
        short, "fuel_type", "co2_combined_g_km", "net_max_power_kw"
    )
    snapshot = star["fact_vehicle_snapshot"].select(
        short,
        packed(F.col("vehicle_key")).alias("vehicle_key"),
        "vehicle_model_key",
        "registration_date_key",
        "powertrain_key",
    )
    # attributes are looked up once a vehicle, before its fuel rows meet it
    snapshot = star_rows(snapshot, star).select("vehicle_snapshot_key", "vehicle_key", *METRIC_KEYS[1:])
    several = vehicles_of_several(star["fact_vehicle_snapshot"])
    once = F.lit(True)
    if several is not None:
        snapshot = snapshot.join(several, F.xxhash64("vehicle_key") == F.col("_hash"), "left")
        once = F.col("_hash").isNull()
    rows = fuel.join(snapshot.withColumn("_once", once).drop("_hash"), "vehicle_snapshot_key")
    return metrics_of_snapshots(rows, exact=several is not None)


def vehicles_of_several(snapshot: DataFrame) -> DataFrame | None:
    """Hashes of packed vehicle keys that stand in several snapshots; None if there are none."""
    vehicle, key = packed(F.col("vehicle_key")), F.xxhash64("vehicle_snapshot_key")
    spans = snapshot.groupBy(F.xxhash64(vehicle).alias("_hash")).agg(F.min(key).alias("a"), F.max(key).alias("b"))
    found = materialize(spans.where("a < b").select("_hash"), "several-snapshots")
    return None if found.isEmpty() else found


def metrics_of_snapshots(rows: DataFrame, exact: bool) -> DataFrame:
    """``aggregate_metrics`` of fuel rows that lie together by their snapshot key.

    They are first added up to a row per snapshot and metric key, where they are. Vehicles that
    stand in one snapshot only (``_once``) are then counted as rows, and only the others
    move with their key to be counted as distinct ones.
    """
    measures = ("co2_combined_g_km", "net_max_power_kw")
    sums = [c for m in measures for c in (F.sum(m).alias(f"s_{m}"), F.count(m).alias(f"n_{m}"))]
    found = rows.groupBy("vehicle_snapshot_key", "vehicle_key", "_once", *METRIC_KEYS).agg(*sums)
    vehicle = F.col("vehicle_key")
    count = F.count(F.when(F.col("_once"), vehicle))
    if exact:
        count = count + F.countDistinct(F.when(~F.col("_once"), vehicle))
    means = [
        round_half_away(F.sum(f"s_{m}") / F.nullif(F.sum(f"n_{m}"), F.lit(0)), 2).alias(f"avg_reported_{m}")
        for m in measures
    ]
    return found.groupBy(*METRIC_KEYS).agg(count.alias("vehicle_count"), *means)


# --- the whole set ---------------------------------------------------------------


def build_models(
    staging: dict[str, DataFrame], spec: SnapshotSpec, write: bool = False
) -> dict[str, DataFrame]:
    """All models over ``vehicles``, ``fuels`` and ``ingestion_runs``.

    Lazy by default. With ``write`` the rows that feed several models are written once
    and read back, so no model recomputes another.
    """
    keep = materialize if write else lambda df, tag: df
    out = {
        "stg_vehicles": stg_vehicles(staging["vehicles"]),
        "stg_fuels": stg_fuels(staging["fuels"]),
        "stg_ingestion_runs": stg_ingestion_runs(staging["ingestion_runs"]),
    }
    key = "vehicle_id_hash"
    vehicles, fuels = (
        out[n].withColumn(SHORT, packed(F.col(key))).drop(key) for n in ("stg_vehicles", "stg_fuels")
    )
    profile = keep(type_profile(fuels, spec, SHORT), "int_vehicle_fuel_profile")
    named = unpacked(F.col(SHORT)).alias(key)
    out["int_vehicle_fuel_profile"] = profile.select(named, *[c for c in profile.columns if c != SHORT])
    out["int_snapshot_context"] = snapshot_context(
        out["stg_vehicles"], out["stg_ingestion_runs"]
    )
    wide = keep(
        wide_snapshot(
            vehicles,
            profile,
            out["stg_ingestion_runs"],
            SHORT,
        ),
        "wide_snapshot",
    ).withColumn(key, unpacked(F.col(SHORT)))
    out["dim_vehicle"] = dim_vehicle(out["stg_vehicles"])
    out["dim_vehicle_model"] = dim_vehicle_model(out["stg_vehicles"], spec)
    out["dim_registration_date"] = dim_registration_date(out["stg_vehicles"])
    out["dim_powertrain"] = dim_powertrain(out["int_vehicle_fuel_profile"], spec)
    out["fact_vehicle_snapshot"] = fact_vehicle_snapshot(wide, spec)
    fuel_rows = wide_fuels(fuels, wide, spec, SHORT)
    if write:
        derived = [key, "vehicle_snapshot_key"]
        fuel_rows = keep(fuel_rows.drop(*derived), "wide_fuels")
        fuel_rows = fuel_rows.withColumn(key, unpacked(F.col(SHORT)))
        fuel_rows = fuel_rows.withColumn("vehicle_snapshot_key", snapshot_key(spec))
    out["fact_vehicle_fuel"] = fact_vehicle_fuel(fuel_rows, spec)
    out["mart_ev_overview"] = mart_ev_overview(wide, spec)
    out["mart_ev_metrics"] = mart_ev_metrics(fuel_rows, SHORT)
    return out
