"""Quality: a linear support vector machine on n-gram indicators scaled by naive Bayes.

A feature is the presence of a run of 2 to 4 bytes of the text, hashed, or of a word 2 to 4
times in a row, whatever the word. Indicators are scaled
by the log ratio of their smoothed class counts, rows by their length; the hinge loss is
minimised by dual coordinate descent. The margin becomes a probability by a logistic
curve fitted on a part of the sample that the machine did not see.
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
from snapharbor.llm.textbytes import Words, text_bytes

BITS = 17
LENGTHS = (2, 3, 4)
REPEATS = 3  # coordinates 0, 1, 2 also stand for a word two, three, four times in a row
KEEP_FROM = 0.3

EXAMPLES = pa.schema([("draw", pa.int64()), ("id", pa.int64()), ("y", pa.int32()), ("on", pa.binary())])
MODEL = pa.schema([("weights", pa.binary()), ("slope", pa.float64()), ("shift", pa.float64())])
SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])


@dataclass(frozen=True)
class Settings:
    """Add-``smooth`` class counts, hinge loss weight ``cost`` and passes over the sample."""

    smooth: float = 1.0
    cost: float = 1.0
    passes: int = 10


def indicators(data: np.ndarray, stamp: np.ndarray) -> np.ndarray:
    """Distinct coordinates of a text's byte runs. ``stamp`` is scratch space, one per coordinate."""
    code = data.astype(np.uint32)
    parts = []
    total = code
    for n in range(2, max(LENGTHS) + 1):
        if len(code) < n:
            break
        total = total[:-1] * np.uint32(257) + code[n - 1 :]
        if n in LENGTHS:
            spread = (total + np.uint32(n * 0x1000193)) * np.uint32(0x9E3779B1)
            parts.append((spread >> np.uint32(32 - BITS)).astype(np.int32))
    if not parts:
        return np.zeros(0, np.int32)
    at = np.concatenate(parts)
    order = np.arange(len(at), dtype=np.int32)
    stamp[at] = order  # the last of equal coordinates stays
    return at[stamp[at] == order]


def row_indicators(column: pa.Array) -> Iterator[np.ndarray]:
    """Distinct coordinates of each text."""
    stamp = np.zeros(1 << BITS, np.int32)
    found = Words(column, fold=False)
    row = found.row_of_word()
    again = (found.hashes[1:] == found.hashes[:-1]) & (row[1:] == row[:-1])
    runs = []
    for k in range(REPEATS):
        runs.append(set(row[1 : len(again) + 1][again].tolist()))
        again = again[1:] & again[:-1]
        row = row[1:]
    data, offsets = text_bytes(column)
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
        at = indicators(data[a:b], stamp)
        extra = [k for k in range(REPEATS) if i in runs[k]]
        yield np.union1d(at, np.array(extra, np.int32)) if extra else at


def _examples(batches):
    for rows in chunks(batches, 1 << 21, "text"):
        sets = [np.sort(at).astype(np.int32).tobytes() for at in row_indicators(rows.column("text"))]
        yield batch(EXAMPLES, rows.column("draw"), rows.column("id"), rows.column("y"), sets)


def fit(examples: list[np.ndarray], labels: np.ndarray, how: Settings) -> np.ndarray:
    """Scaled weights of all coordinates and, last, of the constant. Labels are 0 and 1."""
    size = 1 << BITS
    count = np.full((2, size), how.smooth)
    for on, y in zip(examples, labels):
        count[int(y), on] += 1.0
    ratio = np.log(count[1] / count[1].sum()) - np.log(count[0] / count[0].sum())
    ratio = np.append(ratio, 1.0)
    w = np.zeros(size + 1)
    alpha = np.zeros(len(examples))
    sign = np.where(labels == 1, 1.0, -1.0)
    order = np.random.default_rng(0)
    for _ in range(how.passes):
        for i in order.permutation(len(examples)):
            at = np.append(examples[i], size)
            x = ratio[at]
            length = x @ x  # rows have length 1, so the curvature is 1
            gradient = sign[i] * (w[at] @ x) / np.sqrt(length) - 1.0
            new = min(max(alpha[i] - gradient, 0.0), how.cost)
            if new != alpha[i]:
                w[at] += (new - alpha[i]) * sign[i] / np.sqrt(length) * x
                alpha[i] = new
    return np.stack([w * ratio, ratio * ratio])


def margin(model: np.ndarray, on: np.ndarray) -> float:
    """Distance from the boundary for a row scaled to length 1."""
    weight, square = model
    return float((weight[on].sum() + weight[-1]) / np.sqrt(square[on].sum() + square[-1]))


def logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of P(1 | margin), with targets drawn in from 0 and 1 by class size."""
    ones = labels.sum()
    zeros = len(labels) - ones
    target = np.where(labels == 1, (ones + 1.0) / (ones + 2.0), 1.0 / (zeros + 2.0))
    design = np.stack([margins, np.ones(len(margins))])
    value = np.array([0.0, np.log((ones + 1.0) / (zeros + 1.0))])
    for _ in range(50):
        p = _logistic(value @ design)
        hessian = (design * (p * (1.0 - p))) @ design.T + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, design @ (p - target))
        value = value - np.clip(step, -5.0, 5.0)
        if np.abs(step).max() < 1e-9:
            break
    return float(value[0]), float(value[1])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def _train(how: Settings):
    def run(batches):
        examples, labels, ids = [], [], []
        for rows in batches:
            examples += [np.frombuffer(b.as_buffer(), np.int32) for b in rows.column("on")]
            labels += rows.column("y").to_pylist()
            ids += rows.column("draw").to_pylist()
        y = np.array(labels, float)
        aside = np.array(ids, np.int64) % 5 == 0
        model = fit([x for x, a in zip(examples, aside) if not a], y[~aside], how)
        margins = np.array([margin(model, x) for x, a in zip(examples, aside) if a])
        slope, shift = logistic(margins, y[aside])
        yield batch(MODEL, [model.tobytes()], [slope], [shift])

    return run


def _score(trained):
    def run(batches):
        model, slope, shift = trained.value
        for rows in chunks(batches, 1 << 21, "text"):
            margins = [margin(model, at) for at in row_indicators(rows.column("text"))]
            score = _logistic(slope * np.array(margins, float) + shift)
            yield batch(SCORES, rows.column("doc_id"), rows.column("held_out"), score)

    return run


def _keep(trained, text_col: str):
    def run(batches):
        model, slope, shift = trained.value
        for rows in chunks(batches, 1 << 21, text_col):
            margins = np.array([margin(model, at) for at in row_indicators(rows.column(text_col))], float)
            yield rows.filter(pa.array(_logistic(slope * margins + shift) >= KEEP_FROM))

    return run


def train(docs: DataFrame, labels: DataFrame, how: Settings = Settings(), sample_rows: int = SAMPLE_ROWS):
    """(weights, slope, shift), learnt in one task from the bounded sample."""
    examples = stored(
        training_rows(docs, labels, "quality", sample_rows).mapInArrow(
            _examples, "draw bigint, id bigint, y int, `on` binary"
        ),
        "examples",
    )
    one = examples.repartition(1).sortWithinPartitions("draw", "id", "on")
    row = one.mapInArrow(_train(how), "weights binary, slope double, shift double").first()
    if row is None:  # no labelled row, no task with rows
        return np.stack([np.zeros((1 << BITS) + 1), np.ones((1 << BITS) + 1)]), 0.0, 0.0
    return np.frombuffer(bytes(row["weights"])).reshape(2, -1), row["slope"], row["shift"]


def quality_scores(
    docs: DataFrame, labels: DataFrame, how: Settings = Settings(), sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """Train on the labels and score every row: see ``score_texts``."""
    return score_texts(docs, train(docs, labels, how, sample_rows))


def score_texts(docs: DataFrame, trained) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    ``score`` is the probability that ``labels.quality`` is 1, from the whole text alone; null
    and empty texts get the score of a text without features. ``predicted`` is 1 from 0.3 on.
    Rows with crc32(id) mod 5 = 0 are held out: their labels are never read. A null id
    is not held out and has no label. Without any label all scores are 0.5. Repeated rows and ties get
    equal scores; other columns are ignored.
    """
    spark = prepare(docs.sparkSession)
    model = spark.sparkContext.broadcast(trained)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(fold_of(F.col("doc_id"), HELD_OUT_FOLDS) == 0, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    scored = rows.mapInArrow(_score(model), "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= KEEP_FROM).cast("int"))


def keep_good(docs: DataFrame, trained, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least 0.3; all columns stay. Defined as ``score_texts``."""
    model = prepare(docs.sparkSession).sparkContext.broadcast(trained)
    return docs.mapInArrow(_keep(model, text_col), docs.schema)
