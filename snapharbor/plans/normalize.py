"""Raw text rows to typed, pseudonymised staging rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapharbor.functions.keys import salted_sha256
from snapharbor.functions.text import (
    clean_text,
    clean_upper,
    default_text,
    not_blank,
    parse_compact_date,
    parse_decimal_comma,
    parse_int_default,
    strip,
)
from snapharbor.spec import SnapshotSpec


def drop_blank_id(raw: DataFrame, id_col: str) -> DataFrame:
    return raw.where(not_blank(F.col(id_col)))


def stamp_lineage(ingestion_id: str | Column) -> Column:
    return ingestion_id if isinstance(ingestion_id, Column) else F.lit(ingestion_id)


def normalize_vehicles(
    raw: DataFrame,
    spec: SnapshotSpec,
    ingestion_id: str | Column,
    carry: list[str] | None = None,
) -> DataFrame:
    """Staged vehicle rows; rows without an identifier are dropped.

    ``carry`` names raw columns to keep beside the staged ones.
    """
    return drop_blank_id(raw, spec.raw_id).select(*vehicle_columns(spec, ingestion_id), *(carry or []))


def vehicle_columns(spec: SnapshotSpec, ingestion_id: str | Column) -> list[Column]:
    """What ``normalize_vehicles`` makes of raw columns; whoever normalises often builds them once."""
    field = {name: F.col(raw_name) for name, raw_name in spec.vehicle_fields.items()}
    registered = parse_compact_date(field["registration_date"])
    return [
        salted_sha256(strip(F.col(spec.raw_id)), spec.salt, required=True).alias(
            "vehicle_id_hash"
        ),
        clean_upper(field["brand"]).alias("brand"),
        clean_upper(field["model"]).alias("model"),
        registered.alias("registration_date"),
        F.year(registered).alias("registration_year"),
        clean_upper(field["primary_colour"]).alias("primary_colour"),
        clean_upper(field["secondary_colour"]).alias("secondary_colour"),
        clean_text(field["vehicle_type"]).alias("vehicle_type"),
        stamp_lineage(ingestion_id).alias("ingestion_id"),
    ]


def normalize_fuels(
    raw: DataFrame,
    spec: SnapshotSpec,
    ingestion_id: str | Column,
    carry: list[str] | None = None,
) -> DataFrame:
    """Staged fuel rows; rows without an identifier are dropped."""
    return drop_blank_id(raw, spec.raw_id).select(*fuel_columns(spec, ingestion_id), *(carry or []))


def fuel_columns(spec: SnapshotSpec, ingestion_id: str | Column) -> list[Column]:
    """What ``normalize_fuels`` makes of raw columns."""
    field = {name: F.col(raw_name) for name, raw_name in spec.fuel_fields.items()}
    return [
        salted_sha256(strip(F.col(spec.raw_id)), spec.salt, required=True).alias(
            "vehicle_id_hash"
        ),
        parse_int_default(field["fuel_sequence"], spec.default_sequence).alias(
            "fuel_sequence"
        ),
        default_text(field["fuel_type"], spec.default_fuel_type).alias("fuel_type"),
        clean_text(field["emission_code"]).alias("emission_code"),
        parse_decimal_comma(field["co2_combined_g_km"]).alias("co2_combined_g_km"),
        parse_decimal_comma(field["net_max_power_kw"]).alias("net_max_power_kw"),
        clean_text(field["hybrid_class"]).alias("hybrid_class"),
        stamp_lineage(ingestion_id).alias("ingestion_id"),
    ]
