"""What a two-dataset snapshot looks like: raw fields, classification, key rules."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class SnapshotSpec:
    """Column names and constants that bind the generic operators to one domain."""

    raw_id: str
    vehicle_fields: dict[str, str]
    fuel_fields: dict[str, str]
    wanted_types: tuple[str, ...]
    electric: str
    hydrogen: str
    salt: str = field(default="", repr=False)
    battery_label: str = "Battery electric"
    hybrid_label: str = "Hybrid electric"
    hydrogen_label: str = "Hydrogen electric"
    default_fuel_type: str = "Unknown"
    default_sequence: int = 1
    null_token: str = "<unknown>"
    separator: str = "|"

    @property
    def categories(self) -> list[str]:
        return [self.battery_label, self.hybrid_label, self.hydrogen_label]

    @property
    def raw_vehicle_columns(self) -> list[str]:
        return [self.raw_id, *self.vehicle_fields.values()]

    @property
    def raw_sequence(self) -> str:
        return self.fuel_fields["fuel_sequence"]

    @property
    def raw_fuel_columns(self) -> list[str]:
        return [self.raw_id, *self.fuel_fields.values()]


# Field names and fuel names of the public vehicle datasets.
VEHICLE_SPEC = SnapshotSpec(
    raw_id="kenteken",
    vehicle_fields={
        "brand": "merk",
        "model": "handelsbenaming",
        "registration_date": "datum_eerste_toelating",
        "primary_colour": "eerste_kleur",
        "secondary_colour": "tweede_kleur",
        "vehicle_type": "voertuigsoort",
    },
    fuel_fields={
        "fuel_sequence": "brandstof_volgnummer",
        "fuel_type": "brandstof_omschrijving",
        "emission_code": "emissiecode_omschrijving",
        "co2_combined_g_km": "co2_uitstoot_gecombineerd",
        "net_max_power_kw": "nettomaximumvermogen",
        "hybrid_class": "klasse_hybride_elektrisch_voertuig",
    },
    wanted_types=("Elektriciteit", "Waterstof"),
    electric="elektriciteit",
    hydrogen="waterstof",
)

# Relations a publication must hold, all of them or none.
PUBLISHED_RELATIONS = (
    "dim_powertrain",
    "dim_registration_date",
    "dim_vehicle",
    "dim_vehicle_model",
    "fact_vehicle_fuel",
    "fact_vehicle_snapshot",
    "mart_ev_metrics",
    "mart_ev_overview",
)

# Column names that would expose a plain identifier.
PLAIN_ID_COLUMNS = ("kenteken", "licence_plate", "license_plate", "vehicle_identifier")
GATE_PLAIN_ID_COLUMNS = ("kenteken", "licence_plate", "license_plate")

MAX_PAGE_SIZE = 50_000
DEFAULT_PAGE_SIZE = 1_000
DEFAULT_DETAIL_BATCH = 200
DEFAULT_SNAPSHOT_LIMIT = 10_000


def check_page_size(page_size: int) -> int:
    if not 1 <= page_size <= MAX_PAGE_SIZE:
        raise ValueError(f"page_size must be between 1 and {MAX_PAGE_SIZE}")
    return page_size


def text_schema(columns: list[str]) -> T.StructType:
    """Raw rows carry text only; a missing key reads as NULL."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


STAGED_VEHICLES = T.StructType(
    [
        T.StructField("vehicle_id_hash", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("registration_date", T.DateType()),
        T.StructField("registration_year", T.IntegerType()),
        T.StructField("primary_colour", T.StringType()),
        T.StructField("secondary_colour", T.StringType()),
        T.StructField("vehicle_type", T.StringType()),
        T.StructField("ingestion_id", T.StringType()),
    ]
)

STAGED_FUELS = T.StructType(
    [
        T.StructField("vehicle_id_hash", T.StringType()),
        T.StructField("fuel_sequence", T.IntegerType()),
        T.StructField("fuel_type", T.StringType()),
        T.StructField("emission_code", T.StringType()),
        T.StructField("co2_combined_g_km", T.DoubleType()),
        T.StructField("net_max_power_kw", T.DoubleType()),
        T.StructField("hybrid_class", T.StringType()),
        T.StructField("ingestion_id", T.StringType()),
    ]
)

INGESTION_RUNS = T.StructType(
    [
        T.StructField("ingestion_id", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("completed_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("sample_limit", T.IntegerType()),
        T.StructField("vehicle_rows", T.IntegerType()),
        T.StructField("fuel_rows", T.IntegerType()),
        T.StructField("duplicate_payloads", T.IntegerType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("ingestion_mode", T.StringType()),
        T.StructField("requested_limit", T.LongType()),
        T.StructField("page_size", T.IntegerType()),
        T.StructField("pages_requested", T.IntegerType()),
        T.StructField("source_rows_received", T.LongType()),
        T.StructField("matched_vehicles", T.LongType()),
        T.StructField("rejected_rows", T.LongType()),
        T.StructField("active_duration_seconds", T.DoubleType()),
        T.StructField("wall_clock_elapsed_seconds", T.DoubleType()),
        T.StructField("processed_rows_per_second", T.DoubleType()),
        T.StructField("checkpoint_status", T.StringType()),
        T.StructField("resumed", T.BooleanType()),
        T.StructField("resume_count", T.IntegerType()),
    ]
)

# One arrival of a page in a run; ``stored_in`` and ``block`` are the run and the block that
# hold its payload. ``slot`` is the block of the landing that named it, and one manifest file.
MANIFEST = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("page", T.LongType()),
        T.StructField("chunk", T.LongType()),
        T.StructField("arrival", T.LongType()),
        T.StructField("payload_sha256", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("stored_in", T.StringType()),
        T.StructField("block", T.StringType()),
        T.StructField("duplicate", T.BooleanType()),
        T.StructField("slot", T.StringType()),
    ]
)

# A stored payload; its partitions are the run that stored it, the block and the dataset.
PAYLOADS = T.StructType(
    [
        T.StructField("payload_sha256", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("payload", T.StringType()),
        T.StructField("stored_in", T.StringType()),
        T.StructField("block", T.StringType()),
        T.StructField("dataset", T.StringType()),
    ]
)
