from collections import Counter

from conftest import values
from pyspark.sql import functions as F

from snapharbor.operators.quality import multiset_diff, verify_expected
from snapharbor.plans import models as m


def hashed(spark, spec, pairs):
    import hashlib

    rows = [(hashlib.sha256(f"{spec.salt}:{k}".encode()).hexdigest(), c) for k, c in pairs]
    return spark.createDataFrame(rows, "vehicle_key string, powertrain_category string")


EXPECTED = [
    ("BAT", "Battery electric"),
    ("HYB-P", "Hybrid electric"),
    ("HYB-D", "Hybrid electric"),
    ("HYD", "Hydrogen electric"),
    ("HYD-MIX", "Hydrogen electric"),
    ("ODD", "Hybrid electric"),
]


def test_golden_classification_and_grains(spark, spec, models):
    counts = {
        "dim_vehicle": (models["dim_vehicle"], 6),
        "fact_vehicle_snapshot": (models["fact_vehicle_snapshot"], 6),
        "fact_vehicle_fuel": (models["fact_vehicle_fuel"], 10),
        "mart_ev_overview": (models["mart_ev_overview"], 6),
    }
    findings = verify_expected(
        models["mart_ev_overview"].select("vehicle_key", "powertrain_category"),
        hashed(spark, spec, EXPECTED),
        counts,
    )
    assert findings.collect() == []


def test_wrong_category_is_found(spark, spec, models):
    wrong = hashed(spark, spec, [("BAT", "Hybrid electric"), *EXPECTED[1:]])
    actual = models["mart_ev_overview"].select("vehicle_key", "powertrain_category")
    found = verify_expected(actual, wrong, {"x": (actual, 7)})
    assert values(found) == [("rows", 2), ("x", 1)]


def test_missing_measures_and_dates_stay_null(models):
    both = F.col("co2_combined_g_km").isNull() & F.col("net_max_power_kw").isNull()
    assert models["fact_vehicle_fuel"].where(both).count() == 6
    assert models["mart_ev_overview"].where("registration_date is null").count() == 1
    assert models["dim_registration_date"].count() == 5
    metrics = models["mart_ev_metrics"].where("fuel_type = 'LPG'").first()
    assert metrics["avg_reported_co2_combined_g_km"] is None


def test_run_start_reaches_the_fact(models):
    assert models["fact_vehicle_snapshot"].select("snapshot_started_at").distinct().count() == 1
    assert models["fact_vehicle_snapshot"].where("snapshot_started_at is null").count() == 0


def test_marts_equal_their_star_joins(models):
    diff = multiset_diff(m.star_overview(models), models["mart_ev_overview"])
    assert diff.collect() == []
    diff = multiset_diff(m.star_metrics(models), models["mart_ev_metrics"])
    assert diff.collect() == []


def test_profile_skips_null_types(spark, spec):
    rows = [
        ("a", "Elektriciteit"), ("a", None),
        ("b", None),
        ("c", "ELEKTRICITEIT"), ("c", "Unknown"),
        ("d", "Benzine"),
        ("e", "waterstof"), ("e", "Elektriciteit"), ("e", "Diesel"),
    ]
    df = spark.createDataFrame(rows, "vehicle_id_hash string, fuel_type string")
    got = values(m.type_profile(df, spec), "vehicle_id_hash", "fuel_record_count", "powertrain_category")
    assert got == [("a", 2, "Battery electric"), ("c", 2, "Hybrid electric"), ("e", 3, "Hydrogen electric")]


def test_model_key_collision_is_kept(spark, spec):
    rows = [(None, "m", "t"), ("<unknown>", "m", "t"), (None, "m", "t")]
    df = spark.createDataFrame(rows, "brand string, model string, vehicle_type string")
    dim = m.dim_vehicle_model(df, spec)
    assert dim.count() == 2
    assert dim.select("vehicle_model_key").distinct().count() == 1


def test_context_keeps_unmatched_runs(spark, runs):
    rows = [("run-1",), ("run-1",), ("run-9",)]
    vehicles = spark.createDataFrame(rows, "ingestion_id string")
    context = m.snapshot_context(vehicles, m.stg_ingestion_runs(runs))
    got = {r["ingestion_id"]: r["snapshot_started_at"] for r in context.collect()}
    assert got["run-9"] is None and got["run-1"] is not None and len(got) == 2


def test_vehicles_without_profile_stay_in_the_dimension_only(spark, spec, staging, runs):
    extra = staging["vehicles"].limit(1).withColumn("vehicle_id_hash", F.lit("f" * 64))
    built = m.build_models(
        {**staging, "vehicles": staging["vehicles"].unionByName(extra)}, spec
    )
    assert built["dim_vehicle"].count() == 7
    assert built["fact_vehicle_snapshot"].count() == 6


def test_fuel_of_another_run_is_not_a_fact(spark, spec, staging):
    moved = staging["fuels"].withColumn(
        "ingestion_id",
        F.when(F.col("fuel_type") == "LPG", "run-0").otherwise(F.col("ingestion_id")),
    )
    built = m.build_models({**staging, "fuels": moved}, spec)
    assert built["fact_vehicle_fuel"].count() == 9
    kinds = Counter(r["fuel_type"] for r in built["fact_vehicle_fuel"].collect())
    assert kinds["LPG"] == 0
