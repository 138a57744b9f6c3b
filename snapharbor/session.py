"""Session settings and the shared scratch area."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

# Runtime SQL settings the plans rely on. All of them can be set on a live session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A join key may hold a third of all rows: let AQE split that partition even
    # when the split costs one more exchange further up.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A join must shuffle by all of its keys. Joining on a partitioning left over from an
    # aggregate would save an exchange but could not be split.
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
}


# For jobs of many steps that are each stored: the shuffle files of a step are deleted when it has
# ended, not when the driver happens to collect garbage.
STEP_SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def configure(spark: SparkSession, steps: bool = False) -> SparkSession:
    """Apply the runtime settings, for jobs of many ``steps`` further ones, and return the session."""
    for key, value in {**RUNTIME_SETTINGS, **(STEP_SETTINGS if steps else {})}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


# Bytes, compressed, that a writer gathers before it writes them, and that a reader fetches at once. Spark's 128 MB
# would be held on the heap by every task that writes, and outside of it by every thread that reads.
ROW_GROUP_BYTES = 16 * 1024 * 1024

_own_roots: dict[str, str] = {}
_used: set[str] = set()


def scratch_root(spark: SparkSession) -> str:
    """Folder shared by driver and executors, as named in spark.checkpoint.dir.

    Only a local session without any checkpoint folder (a test) gets a temporary one:
    on a cluster, executors would write to disks of their own.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        master = context.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _own_roots.get(context.applicationId) or tempfile.mkdtemp(prefix="snapharbor-")
        _own_roots[context.applicationId] = root
    return root.rstrip("/")


def scratch_folder(spark: SparkSession) -> str:
    """Where this application keeps what it writes between steps."""
    return f"{scratch_root(spark)}/snapharbor/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, tag: str) -> str:
    folder = scratch_folder(spark)
    if folder not in _used:
        _used.add(folder)
        atexit.register(_clear_at_exit, spark, folder)
    return f"{folder}/{tag}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has written between steps.

    A frame that was built on it can no longer be read. It also happens when the driver
    ends; a long session calls it between jobs.
    """
    _delete(spark, scratch_folder(spark))


def _clear_at_exit(spark: SparkSession, folder: str) -> None:
    if spark.sparkContext._jsc is not None and folder == scratch_folder(spark):
        clear_scratch(spark)


def stored_writer(df: DataFrame, mode: str) -> DataFrameWriter:
    """How what is read again is written: compressed, in row groups of bounded size."""
    writer = df.write.mode(mode).option("compression", "zstd")
    return writer.option("parquet.block.size", ROW_GROUP_BYTES)


def materialize(df: DataFrame, tag: str, rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` to the shared scratch area and read it back.

    Cuts lineage in a way that survives lost executors, fixes non-deterministic
    columns, and gives Catalyst real file sizes to plan the next joins with. A reader holds up to
    4,096 rows of a file at a time; ``rows_per_file`` keeps that small where rows are large.
    """
    return _stored(df, scratch_path(df.sparkSession, tag), rows_per_file)


@contextmanager
def stored_meanwhile(df: DataFrame, tag: str, rows_per_file: int = 0) -> Iterator[DataFrame]:
    """``materialize`` for a block of code, behind which nothing reads the copy: it is deleted."""
    path = scratch_path(df.sparkSession, tag)
    try:
        yield _stored(df, path, rows_per_file)
    finally:
        _delete(df.sparkSession, path)


def _stored(df: DataFrame, path: str, rows_per_file: int) -> DataFrame:
    writer = stored_writer(df, "errorifexists")
    writer.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def run_together(jobs: list[Callable[[], object]], at_once: int = 4) -> list:
    """Run independent Spark jobs side by side, so small ones fill idle slots.

    All jobs end before the first failure is raised.
    """
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        futures = [pool.submit(job) for job in jobs]
    return [f.result() for f in futures]
