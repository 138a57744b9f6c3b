"""Named tables and their catalog."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapharbor.session import run_together
from snapharbor.spec import INGESTION_RUNS, STAGED_FUELS, STAGED_VEHICLES

STAGING_TABLES = {
    "vehicles": STAGED_VEHICLES,
    "fuels": STAGED_FUELS,
    "ingestion_runs": INGESTION_RUNS,
}


def scan_staging(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The source tables of the models, read with their declared schemas."""
    return {
        name: spark.read.schema(schema).parquet(f"{root}/{name}")
        for name, schema in STAGING_TABLES.items()
    }


def write_staging(tables: dict[str, DataFrame], root: str) -> None:
    def write(name: str) -> None:
        df = tables[name]
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/{name}")

    run_together([partial(write, name) for name in tables])


def bind_rows(spark: SparkSession, rows: list, schema) -> DataFrame:
    """In-memory rows as a relation, for fixtures."""
    return spark.createDataFrame(rows, schema)


def catalog_rows(tables: dict[str, DataFrame]) -> list[tuple[str, str, str]]:
    """(relation, column, type) of every column, from the schemas alone."""
    return [
        (name, field.name, field.dataType.simpleString())
        for name, df in tables.items()
        for field in df.schema
    ]


def catalog_scan(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    return spark.createDataFrame(
        catalog_rows(tables), "relation string, column_name string, data_type string"
    )


def output_inventory(tables: dict[str, DataFrame], required: tuple[str, ...]) -> DataFrame:
    """(relation, rows) of the required relations; a missing one is an error."""
    missing = sorted(set(required) - set(tables))
    if missing:
        raise ValueError("missing analytical relations: " + ", ".join(missing))
    counts = [
        tables[name]
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("relation"), "rows")
        for name in sorted(required)
    ]
    return reduce(DataFrame.unionByName, counts)


def describe_parquet(spark: SparkSession, path: str) -> list[str]:
    return spark.read.parquet(path).columns
