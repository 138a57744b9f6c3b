from __future__ import annotations

import os
import sys
from dataclasses import replace

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from snapharbor.session import configure  # noqa: E402
from snapharbor.spec import VEHICLE_SPEC, text_schema  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("snapharbor-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def spec():
    return replace(VEHICLE_SPEC, salt="test-salt")


def vehicle(key, brand="Acme", model="One", date="20200115", kind="Personenauto"):
    return (key, brand, model, date, "blauw", None, kind)


def fuel(key, seq, name, co2=None, power=None, hybrid=None):
    return (key, seq, name, None, co2, power, hybrid)


# Six vehicles, one per classification case, with ten fuel rows.
RAW_VEHICLES = [
    vehicle("BAT"),
    vehicle("HYB-P", model="Two", date="20190630"),
    vehicle("HYB-D", brand="Beta", date="20181231"),
    vehicle("HYD", brand="Gamma", date=""),
    vehicle("HYD-MIX", brand="Gamma", date="20210301"),
    vehicle("ODD", brand="Delta", date="20220704"),
]
RAW_FUELS = [
    fuel("BAT", "1", "Elektriciteit", power="150,00"),
    fuel("HYB-P", "1", "Elektriciteit", power="75.5"),
    fuel("HYB-P", "2", "Benzine", co2="41"),
    fuel("HYB-D", "1", "Elektriciteit"),
    fuel("HYB-D", "2", "Diesel", co2="38", hybrid="OVC-HEV"),
    fuel("HYD", "1", "Waterstof"),
    fuel("HYD-MIX", "1", "Waterstof"),
    fuel("HYD-MIX", "2", "Benzine"),
    fuel("ODD", "1", "Elektriciteit"),
    fuel("ODD", "2", "LPG"),
]


@pytest.fixture(scope="session")
def raw(spark, spec):
    vehicles = spark.createDataFrame(RAW_VEHICLES, text_schema(spec.raw_vehicle_columns))
    fuels = spark.createDataFrame(RAW_FUELS, text_schema(spec.raw_fuel_columns))
    return vehicles, fuels


@pytest.fixture(scope="session")
def runs(spark):
    from datetime import datetime

    from snapharbor.operators.runs import evolve_runs

    rows = [("run-1", datetime(2024, 5, 1, 12), "running", 6, 6, 10)]
    names = "ingestion_id string, started_at timestamp, status string, sample_limit int, vehicle_rows int, fuel_rows int"
    return evolve_runs(spark.createDataFrame(rows, names))


@pytest.fixture(scope="session")
def staging(raw, runs, spec):
    from snapharbor.plans.normalize import normalize_fuels, normalize_vehicles

    vehicles, fuels = raw
    return {
        "vehicles": normalize_vehicles(vehicles, spec, "run-1"),
        "fuels": normalize_fuels(fuels, spec, "run-1"),
        "ingestion_runs": runs,
    }


@pytest.fixture(scope="session")
def models(spark, staging, spec):
    from snapharbor.plans.models import build_models

    return build_models(staging, spec, write=True)


def values(df, *columns):
    """Rows as sorted tuples; NULL sorts first."""
    rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=lambda r: [(v is not None, str(v)) for v in r])
