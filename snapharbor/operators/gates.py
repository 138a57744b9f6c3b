"""The staging gate: schema first, then seven counters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapharbor.functions.keys import packed, unpacked
from snapharbor.spec import GATE_PLAIN_ID_COLUMNS

TEXT = (T.StringType,)
DATE = (T.DateType,)
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
NUMBER = (*WHOLE, T.FloatType, T.DoubleType, T.DecimalType)

# Columns the models need, with the type family each may have.
REQUIRED_STAGING = {
    "vehicles": {
        "vehicle_id_hash": TEXT,
        "brand": TEXT,
        "model": TEXT,
        "registration_date": DATE,
        "registration_year": WHOLE,
        "primary_colour": TEXT,
        "secondary_colour": TEXT,
        "vehicle_type": TEXT,
        "ingestion_id": TEXT,
    },
    "fuels": {
        "vehicle_id_hash": TEXT,
        "fuel_sequence": WHOLE,
        "fuel_type": TEXT,
        "emission_code": TEXT,
        "co2_combined_g_km": NUMBER,
        "net_max_power_kw": NUMBER,
        "hybrid_class": TEXT,
        "ingestion_id": TEXT,
    },
}


def _fits(dtype: T.DataType, family: tuple[type, ...]) -> bool:
    if isinstance(dtype, T.DecimalType) and family == WHOLE:
        return dtype.scale == 0
    return isinstance(dtype, family)


def schema_problems(
    tables: dict[str, DataFrame], required: dict[str, dict[str, tuple]] | None = None
) -> list[str]:
    """Missing tables, missing columns and columns of a wrong type family."""
    problems = []
    for table, columns in (required or REQUIRED_STAGING).items():
        if table not in tables:
            problems.append(f"missing staging.{table}")
            continue
        types = {f.name: f.dataType for f in tables[table].schema}
        for column, family in columns.items():
            if column not in types:
                problems.append(f"missing staging.{table}.{column}")
            elif not _fits(types[column], family):
                found = types[column].simpleString().split("(")[0].upper()
                problems.append(f"incompatible staging.{table}.{column} type {found}")
    return problems


def schema_gate(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    required: dict[str, dict[str, tuple]] | None = None,
) -> DataFrame:
    rows = [(p,) for p in schema_problems(tables, required)]
    return spark.createDataFrame(rows, "problem string")


def banned_columns(tables: dict[str, DataFrame], names: tuple[str, ...]) -> list[tuple[str, str]]:
    """(table, column) pairs whose column name is banned."""
    banned = set(names)
    return [(t, c) for t, df in tables.items() for c in df.columns if c.lower() in banned]


def staging_gate(
    vehicles: DataFrame, fuels: DataFrame, others: dict[str, DataFrame] | None = None
) -> DataFrame:
    """(check, violations) for the seven staging checks, in one exchange.

    Both tables are tagged, stacked and reduced to one row per hash; every counter,
    the orphan check included, is then a sum over those rows. A hash held by very many
    rows is reduced where it is read, and no join takes place.
    """
    key = F.col("vehicle_id_hash")
    zero = F.lit(0)
    bad_year = F.col("registration_year").isNotNull() & (
        (F.col("registration_year") < 1900)
        | (F.col("registration_year") > F.year(F.current_date()) + 1)
    )
    short = packed(key).alias("vehicle_id_hash")
    stacked = vehicles.select(
        short, F.lit(1).alias("v"), zero.alias("f"), F.when(bad_year, 1).otherwise(0).alias("y")
    ).unionByName(fuels.select(short, zero.alias("v"), F.lit(1).alias("f"), zero.alias("y")))
    per_key = stacked.groupBy("vehicle_id_hash").agg(
        F.sum("v").alias("v"), F.sum("f").alias("f"), F.sum("y").alias("y")
    ).withColumn("vehicle_id_hash", unpacked(key))

    def total(col) -> F.Column:
        return F.coalesce(F.sum(col), zero).cast("long")

    bad_hash = key.isNotNull() & ~key.rlike("^[0-9a-f]{64}$")
    plain = len(
        banned_columns(
            {"vehicles": vehicles, "fuels": fuels, **(others or {})}, GATE_PLAIN_ID_COLUMNS
        )
    )
    checks = {
        "null_vehicle_hashes": total(F.when(key.isNull(), F.col("v"))),
        "duplicate_vehicles": total(F.when(F.col("v") > 1, 1)),
        "orphan_fuels": total(F.when(key.isNull() | (F.col("v") == 0), F.col("f"))),
        "plain_identifier_columns": F.lit(plain).cast("long"),
        "invalid_vehicle_hashes": total(F.when(bad_hash, F.col("v"))),
        "invalid_registration_years": total("y"),
        "empty_vehicle_staging": F.when(total("v") == 0, 1).otherwise(0).cast("long"),
    }
    row = per_key.agg(*[c.alias(n) for n, c in checks.items()])
    return row.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(n).alias("check"), F.col(n).alias("violations"))
                    for n in checks
                ]
            )
        ).alias("c")
    ).select("c.check", "c.violations")


def classification_violations(profile: DataFrame, expected) -> DataFrame:
    """Profiles whose stored category differs from the recomputed one."""
    return profile.where(F.col("powertrain_category") != expected)

