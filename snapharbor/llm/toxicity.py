"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the presence of words, pairs of neighbours and pairs with one word between,
hashed to ``2**BITS`` coordinates. Each coordinate has its own learning rate, and L1 keeps
most weights at exactly zero, so that the model is a short list that every task gets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapharbor.llm.labelled import HELD_OUT_FOLDS, SAMPLE_ROWS, training_rows
from snapharbor.llm.shared import batch, chunks, fold_of, prepare, stored
from snapharbor.llm.textbytes import Words, mix

BITS = 20
GAPS = (0, 1, 2)  # a word alone, with the next, with the one after it
_TURN = np.uint64(0xD6E8FEB86659FD93)

EXAMPLES = pa.schema([("draw", pa.int64()), ("id", pa.int64()), ("y", pa.int32()), ("on", pa.binary())])
WEIGHTS = pa.schema([("at", pa.int32()), ("weight", pa.float64())])
SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])


@dataclass(frozen=True)
class Settings:
    """FTRL-proximal: rate alpha / (beta + sqrt(sum of squared gradients)), L1 and L2."""

    alpha: float = 4.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.0
    passes: int = 8


def features(found: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, coordinate) of every word, pair and skip pair; may repeat."""
    row = found.row_of_word()
    h = found.hashes
    with np.errstate(over="ignore"):
        for gap in GAPS:
            if gap == 0:
                yield row, (mix(h) >> np.uint64(64 - BITS)).astype(np.int32)
            elif len(h) > gap:
                same = row[gap:] == row[:-gap]
                pair = mix(h[:-gap][same] * _TURN + h[gap:][same] + np.uint64(gap))
                yield row[gap:][same], (pair >> np.uint64(64 - BITS)).astype(np.int32)


def _examples(batches: Iterator[pa.RecordBatch]):
    for rows in chunks(batches, 1 << 21, "text"):
        found = Words(rows.column("text"))
        row, at = (np.concatenate(c) for c in zip(*features(found), strict=True)) if len(found.hashes) else (np.zeros(0, int), np.zeros(0, np.int32))
        key = np.unique(row.astype(np.int64) << BITS | at)
        row, at = key >> BITS, (key & ((1 << BITS) - 1)).astype(np.int32)
        ends = np.searchsorted(row, np.arange(rows.num_rows + 1))
        sets = [at[ends[i] : ends[i + 1]].tobytes() for i in range(rows.num_rows)]
        yield batch(EXAMPLES, rows.column("draw"), rows.column("id"), rows.column("y"), sets)


def fit(examples: list[np.ndarray], labels: np.ndarray, how: Settings) -> np.ndarray:
    """Weights of all coordinates and, last, of the constant, which has no L1."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    l1 = np.full(size, how.l1)
    l1[-1] = 0.0

    def weights(at):
        past = z[at]
        keep = np.abs(past) > l1[at]
        w = -(past - np.sign(past) * l1[at]) / ((how.beta + np.sqrt(n[at])) / how.alpha + how.l2)
        return np.where(keep, w, 0.0)

    for _ in range(how.passes):
        for on, y in zip(examples, labels):
            at = np.append(on, size - 1)
            w = weights(at)
            p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35.0, 35.0)))
            g = p - y
            if g:
                seen = n[at]
                z[at] += g - (np.sqrt(seen + g * g) - np.sqrt(seen)) / how.alpha * w
                n[at] = seen + g * g
    return weights(np.arange(size))


def _train(how: Settings):
    def run(batches):
        examples, labels = [], []
        for rows in batches:
            examples += [np.frombuffer(b.as_buffer(), np.int32) for b in rows.column("on")]
            labels += rows.column("y").to_pylist()
        w = fit(examples, np.array(labels, float), how)
        at = np.flatnonzero(w)
        yield batch(WEIGHTS, at.astype(np.int32), w[at])

    return run


def _score(model):
    def run(batches):
        at, weight = model.value
        dense = np.zeros((1 << BITS) + 1)
        dense[at] = weight
        for rows in chunks(batches, 1 << 21, "text"):
            total = np.full(rows.num_rows, dense[-1])
            keys = []
            for row, feature in features(Words(rows.column("text"))):
                on = np.flatnonzero(dense[feature])
                keys.append(row[on].astype(np.int64) << BITS | feature[on])
            key = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
            total += np.bincount(key >> BITS, dense[key & ((1 << BITS) - 1)], rows.num_rows)
            score = 1.0 / (1.0 + np.exp(-np.clip(total, -35.0, 35.0)))
            yield batch(SCORES, rows.column("doc_id"), rows.column("held_out"), score)

    return run


def train(docs: DataFrame, labels: DataFrame, how: Settings = Settings(), sample_rows: int = SAMPLE_ROWS):
    """(coordinates, weights) that are not zero, learnt in one task from the bounded sample."""
    examples = stored(
        training_rows(docs, labels, "toxic", sample_rows).mapInArrow(
            _examples, "draw bigint, id bigint, y int, `on` binary"
        ),
        "examples",
    )
    one = examples.repartition(1).sortWithinPartitions("draw", "id", "on")
    rows = one.mapInArrow(_train(how), "`at` int, weight double").collect()
    return np.array([r["at"] for r in rows], np.int64), np.array([r["weight"] for r in rows], float)


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, how: Settings = Settings(), sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """One row per input row: (doc_id, held_out, score, predicted).

    ``score`` is the probability that ``labels.toxic`` is 1, from the whole text alone; null,
    empty and blank texts get the score of the constant. ``predicted`` is 1 from 0.5 on. Rows
    with crc32(id) mod 5 = 0 are held out: their labels are never read. A null id is not
    held out and has no label. Without any label all weights are 0 and scores 0.5. Repeated rows
    and ties get equal scores; other columns are ignored.
    """
    spark = prepare(docs.sparkSession)
    model = spark.sparkContext.broadcast(train(docs, labels, how, sample_rows))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(fold_of(F.col("doc_id"), HELD_OUT_FOLDS) == 0, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    scored = rows.mapInArrow(_score(model), "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
