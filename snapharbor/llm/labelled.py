"""The bounded sample of labelled documents that a classifier learns from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapharbor.llm.shared import fold_of, stored

SAMPLE_ROWS = 20_000
HELD_OUT_FOLDS = 5


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """(id, y, draw, text): at most ``sample_rows`` labelled rows, one an id, in a fixed random order.

    An id takes part if crc32 of its decimal text modulo 5 is not 0. Null labels do not
    count; of several labels of one id the largest does. The sample is those ids with the
    smallest hash, so it is all labelled ids if there are no more than the bound, and it is
    small enough to broadcast. Of rows of ``docs`` that share a sampled id one stays, the one whose text
    has the smallest hash, so that an id of very many rows cannot break the bound.
    """
    ids = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .where(fold_of(F.col("doc_id"), HELD_OUT_FOLDS) != 0)
        .groupBy(F.col("doc_id").cast("bigint").alias("_id"))
        .agg(F.max(F.col(label).cast("int")).alias("_y"))
        .withColumn("_draw", F.xxhash64(F.lit(label), "_id"))
        .orderBy("_draw", "_id")
        .limit(sample_rows)
    )
    ids = stored(ids, "sample")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("_id"), F.col("text").cast("string").alias("text"))
    # Reduced where rows are read: a hot id moves one text a task.
    rank = F.struct(F.col("text").isNull(), F.xxhash64("text"), F.xxhash64("text", F.lit("tie")))
    found = texts.join(F.broadcast(ids), "_id").groupBy("_id", "_y", "_draw").agg(F.min_by("text", rank).alias("text"))
    return found.select(
        F.col("_id").alias("id"), F.col("_y").alias("y"), F.col("_draw").alias("draw"), "text"
    )
