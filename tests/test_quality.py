import pytest
from conftest import values
from pyspark.sql import functions as F

from snapharbor.operators import gates, quality, scans, topn


def test_generic_tests(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "b"), (None, "z")], "k int, v string")
    assert quality.dq_not_null(df, "k").count() == 2
    assert values(quality.dq_unique(df, "k")) == [(1, 2)]
    assert values(quality.dq_unique_expr(df, F.concat("v", F.lit("!")))) == [("b!", 2)]
    parent = spark.createDataFrame([(1,), (1,)], "id int")
    assert values(quality.dq_relationship(df, "k", parent, "id")) == [(2, 1)]
    assert values(quality.dq_accepted_values(df, "v", ["a", "b"])) == [("z", 1)]


def test_multiset_diff_counts_copies(spark):
    a = spark.createDataFrame([(1, None)] * 3 + [(2, "x")], "k int, v string")
    b = spark.createDataFrame([(1, None), (3, "y")], "k int, v string")
    assert values(quality.multiset_diff(a, b)) == [
        (1, None, "expected", 2), (2, "x", "expected", 1), (3, "y", "actual", 1)
    ]
    assert quality.multiset_diff(a, a).collect() == []


def test_counts_and_ranges(spark):
    a, b = spark.range(3), spark.range(4)
    assert values(quality.count_mismatch({"same": (a, a), "less": (a, b)})) == [("less", 3, 4)]
    days = spark.createDataFrame([("1899-12-31",), ("1900-01-01",), (None,)], "d string").select(
        F.col("d").cast("date").alias("d")
    ).unionByName(spark.range(1).select(F.date_add(F.current_date(), 400).alias("d")))
    assert quality.dq_date_range(days, "d").count() == 2


def test_below_reports_each_measure(spark):
    df = spark.createDataFrame([(-1.0, 0), (None, 5), (2.0, 1)], "x double, n int")
    found = quality.dq_below(df, {"x": (F.col("x"), 0), "n": (F.col("n"), 1)})
    assert values(found) == [("n",), ("x",)]


def test_runner_raises_with_counts(spark):
    checks = quality.run_tests({"ok": spark.range(0), "bad": spark.range(2)})
    with pytest.raises(quality.DataQualityError, match="'bad': 2"):
        quality.raise_on_violations(checks)
    assert quality.raise_on_violations(checks.where("check = 'ok'")) == {"ok": 0}


def test_staging_gate_counts(spark):
    good, other = "0" * 64, "a" * 64
    vehicles = spark.createDataFrame(
        [(good, 2000), (good, 1800), (None, None), ("XYZ", 3000), (other, None)],
        "vehicle_id_hash string, registration_year int",
    )
    fuels = spark.createDataFrame([(good,), ("b" * 64,), (None,), (None,)], "vehicle_id_hash string")
    got = {r["check"]: r["violations"] for r in gates.staging_gate(vehicles, fuels).collect()}
    assert got == {
        "null_vehicle_hashes": 1,
        "duplicate_vehicles": 1,
        "orphan_fuels": 3,
        "plain_identifier_columns": 0,
        "invalid_vehicle_hashes": 1,
        "invalid_registration_years": 2,
        "empty_vehicle_staging": 0,
    }
    raw = spark.createDataFrame([("x",)], "Kenteken string")
    named = gates.staging_gate(vehicles.limit(0), fuels.limit(0), {"raw": raw})
    got = {r["check"]: r["violations"] for r in named.collect()}
    assert got["plain_identifier_columns"] == 1 and got["empty_vehicle_staging"] == 1


def test_schema_gate(spark, staging):
    assert gates.schema_problems(staging) == []
    broken = {
        "vehicles": staging["vehicles"].withColumn("vehicle_id_hash", F.lit(1)).drop("brand"),
        "fuels": staging["fuels"].withColumn("co2_combined_g_km", F.lit(1).cast("decimal(9,2)")),
    }
    assert gates.schema_problems(broken) == [
        "incompatible staging.vehicles.vehicle_id_hash type INT",
        "missing staging.vehicles.brand",
    ]
    assert gates.schema_gate(spark, {}).count() == 2


def test_audit_patterns(spark):
    rows = [
        (1, "key AKIA" + "A" * 16 + " here"),
        (2, "path C:\\temp and xhttp://no"),
        (3, "see /home/someone/x"),
        (4, "ghp" + "_abc123"),
        (5, "-----BEGIN RSA PRIVATE KEY" + "-----"),
        (6, "nothing; https://example.org/a"),
        (7, None),
    ]
    df = spark.createDataFrame(rows, "id int, text string")
    assert values(scans.scan_patterns(df, "id", "text")) == [
        (1, "AWS access key"),
        (2, "absolute Windows path"),
        (3, "absolute user-home path"),
        (4, "GitHub token"),
        (5, "private key"),
    ]


def test_plaintext_values(spark, models, raw, spec):
    ids = raw[0].select(spec.raw_id)
    assert scans.scan_plaintext_values(models, ids, spec.raw_id).collect() == []
    leak = {"leak": spark.createDataFrame([("BAT", 1), ("BAT", 2), ("ok", 3)], "note string, n int")}
    assert values(scans.scan_plaintext_values(leak, ids, spec.raw_id)) == [("leak", "note", 2)]


def test_topn_keeps_ties(spark):
    df = spark.createDataFrame([("a", 5), ("b", 4), ("c", 4), ("d", 1), ("e", None)], "g string, n int")
    assert values(topn.topn_with_ties(df, "n", 2), "g") == [("a",), ("b",), ("c",)]
    assert topn.topn_with_ties(df, "n", 50).count() == 4


def test_only_cells_that_may_be_ids_move(spark):
    ids = spark.range(5000).select(F.concat(F.lit("id"), F.col("id").cast("string")).alias("value"))
    cells = spark.range(20000).select(F.concat(F.lit("id"), (F.col("id") * 1000).cast("string")).alias("value"), F.lit("r").alias("relation"))
    words = scans.id_filter(ids, "value")
    passed = scans.may_be_ids(cells, words, "value")
    hits = {f"id{k}" for k in range(0, 5000, 1000)}
    found = [r["value"] for r in passed.collect()]
    assert hits <= set(found) and len(found) < 50 and passed.columns == cells.columns
    assert words.count() <= scans.FILTER_BITS // 64
