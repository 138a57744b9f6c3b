"""Upserts that rewrite only the part of a table that they touch.

The table is stored in hash buckets of its key, one partition folder each. An upsert reads and
writes the buckets that hold an incoming key; the files of all others stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapharbor.operators.upsert import keep_last, upsert_by_key
from snapharbor.session import materialize

BUCKETS = 256
BUCKET = "_bucket"


def bucket_of(keys: list[str], schema: T.StructType, buckets: int) -> Column:
    """Bucket of a key, in the type in which the table stores it."""
    typed = [F.col(k).cast(schema[k].dataType) for k in keys]
    return F.pmod(F.xxhash64(*typed), F.lit(buckets)).cast("int").alias(BUCKET)


def write_buckets(df: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS) -> None:
    """Store a table in buckets. A bucket that a hot key has inflated is written by several tasks."""
    _write(df.select("*", bucket_of(keys, df.schema, buckets)), path, "errorifexists")


def read_buckets(spark: SparkSession, path: str, schema: T.StructType, only: list[int] | None = None) -> DataFrame:
    """Rows of the table, or of some buckets; no other folder is read."""
    stored = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    rows = spark.read.schema(stored).parquet(path)
    return rows if only is None else rows.where(F.col(BUCKET).isin(only))


def upsert_buckets(
    incoming: DataFrame,
    path: str,
    schema: T.StructType,
    keys: list[str],
    buckets: int = BUCKETS,
    dedupe: str = "none",
    order: list[Column] | None = None,
) -> list[int]:
    """``upsert_by_key`` on a stored table; returns the buckets that were rewritten.

    ``buckets`` is the number the table was written with. The result of a bucket is written aside
    before it takes the bucket's place, bucket by bucket; an upsert that broke off is run again and
    leaves the same rows. One writer at a time.
    """
    spark = incoming.sparkSession
    if dedupe == "last":
        incoming = keep_last(incoming, keys, order or [])
    elif dedupe != "none":
        raise ValueError("dedupe must be 'none' or 'last'")
    typed = incoming.select(*[F.col(f.name).cast(f.dataType) for f in schema])
    rows = materialize(typed.select("*", bucket_of(keys, schema, buckets)), "incoming")
    touched = sorted(r[0] for r in rows.select(BUCKET).distinct().collect())  # at most ``buckets`` rows
    if touched:
        target = read_buckets(spark, path, schema, touched)
        merged = upsert_by_key(target, rows, [*keys, BUCKET])
        _write(materialize(merged, "merged"), path, "overwrite")
    return touched


def _write(rows: DataFrame, path: str, mode: str) -> None:
    # AQE splits a bucket that is too large for a task and joins small ones
    spread = rows.hint("rebalance", F.col(BUCKET))
    writer = spread.write.mode(mode).partitionBy(BUCKET).option("partitionOverwriteMode", "dynamic")
    writer.option("compression", "zstd").parquet(path)
