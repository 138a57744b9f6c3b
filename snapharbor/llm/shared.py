"""Reading inputs, cutting lineage and passing rows as Arrow for the llm operators."""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from snapharbor.llm.textbytes import slices
from snapharbor.session import configure, materialize

# Functions of this package travel to the executors with the job, so that nothing has
# to be installed there.
cloudpickle.register_pickle_by_value(sys.modules["snapharbor.llm"])

# What is handed to Python at a time: texts may be long, so batches are small.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    for key, value in BATCH_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: lineage ends here,
    and a lost executor loses nothing."""
    return materialize(df, f"llm-{tag}")


def dropped(df: DataFrame) -> None:
    """Delete the files of a frame that ``stored`` returned and nothing reads any more."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shipped(spark: SparkSession, value: object) -> Broadcast:
    """A broadcast of a value whose class is defined in this package: see ``opened``."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def opened(value: Broadcast):
    return pickle.loads(value.value)


def most_frequent(counts: DataFrame, count: str, rows: int) -> list[Row]:
    """The rows of ``counts`` above the least count that leaves ``rows`` of them at most.

    Counts are first counted by 64ths of their power of two, some thousand buckets at most, so
    that no task sends more to the driver than what is kept.
    """
    bucket = F.floor(F.log2(count) * 64).cast("int")
    sizes = counts.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    total, least = 0, None
    for r in sorted(sizes, key=lambda r: -r["b"]):
        total += r["n"]
        if total > rows:
            break
        least = r["b"]
    return [] if least is None else counts.where(bucket >= least).collect()


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as decimal text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(folds)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(columns, schema)],
        schema=schema,
    )


def chunks(batches: Iterator[pa.RecordBatch], target: int, column: str) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``target`` bytes of text."""
    for rows in batches:
        for a, b in slices(rows.column(column), target):
            yield rows.slice(a, b - a)
