"""Language-model scores of whole documents, learnt on the corpus itself.

Tokens are lower-cased words and one end per text. Counts of all tokens of all training
documents give the base: a unigram model with one added to each count. The model proper is
the recurrent one of ``gru``: it predicts the commonest words and the end one by one, all
other words together as one class, and within that class a word has its smoothed count's
share. Words are counted and looked up on the cluster: the most frequent ones go to
every task as a bounded list, all others are joined by hash.

Training is data-parallel: in each round every task goes over its own documents of that round from
the common parameters, and the average of the results, weighted by tokens, is the next
common model. The rounds together go over every training document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapharbor.llm import gru
from snapharbor.llm.shared import batch, chunks, fold_of, most_frequent, opened, prepare, shipped, stored
from snapharbor.llm.textbytes import Words, signed

FOLDS, HELD_OUT = 7, 2
END = 0  # stands for the end token among word hashes
# Words that every task knows the count of; the others are joined.
FREQUENT_ROWS = 200_000
COUNT_BLOCK = 1 << 22
PARAMETER_BLOCK = 1 << 13

COUNTS = pa.schema([("w", pa.int64()), ("c", pa.int64())])
PARAMETERS = pa.schema([("block", pa.int32()), ("weight", pa.float64()), ("value", pa.binary())])
SCORED = pa.schema(
    [("kind", pa.int32()), ("key", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_())]
    + [("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("model", pa.float64())]
    + [("w", pa.int64()), ("many", pa.int32())]
)
SCORED_DDL = (
    "kind int, key bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
    "base double, model double, w bigint, many int"
)


@dataclass(frozen=True)
class Settings:
    """``known`` words of their own, ``hidden`` units, and rounds of training: round r learns
    from part r modulo ``parts`` of the training rows. The rounds go over all parts equally often."""

    known: int = 2048
    hidden: int = 16
    rounds: int = 3
    parts: int = 3
    rate: float = 0.2
    group: int = 64

    def __post_init__(self):
        if self.parts < 1 or self.rounds < 1 or self.rounds % self.parts:
            raise ValueError("rounds must be a multiple of parts, or training rows are left out")


class Finder:
    """Position of 64-bit keys in a sorted list, or -1."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.shift = np.uint64(64 - max(1, int(2 * len(keys)).bit_length()))
        slots = np.arange(1 << (64 - int(self.shift)), dtype=np.uint64) << self.shift
        self.start = np.append(np.searchsorted(keys, slots), len(keys))

    def find(self, h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), -1, np.int64)
        slot = (h >> self.shift).astype(np.int64)
        at, end = self.start[slot], self.start[slot + 1]
        left = np.flatnonzero(at < end)
        while len(left):
            hit = self.keys[at[left]] == h[left]
            out[left[hit]] = at[left[hit]]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < end[left]]
        return out


def _count(batches):
    """(word, occurrences in training rows) per block of words; the end counts the rows."""

    def report(kept, rows):
        words, count = np.unique(np.concatenate(kept), return_counts=True)
        return batch(COUNTS, np.append(signed(words), END), np.append(count, rows))

    kept, size, rows_seen = [], 0, 0
    for rows in chunks(batches, 1 << 21, "text"):
        kept.append(Words(rows.column("text")).hashes)
        size += len(kept[-1])
        rows_seen += rows.num_rows
        if size >= COUNT_BLOCK:
            yield report(kept, rows_seen)
            kept, size, rows_seen = [], 0, 0
    if rows_seen:
        yield report(kept, rows_seen)


@dataclass
class Lexicon:
    """Counts of the frequent words (sorted by hash), their tokens, and the corpus totals."""

    keys: np.ndarray
    count: np.ndarray
    token: np.ndarray  # 1 to known-1, or known for a word without a number
    ends: int
    known: int
    total: int  # N
    distinct: int  # V
    token_counts: np.ndarray  # of tokens 0 to known

    @property
    def rare_total(self) -> int:
        """Denominator within the class of other words: counts, one for each, one for unseen."""
        numbered = int((self.token < self.known).sum()) + int(self.ends > 0)
        return int(self.token_counts[-1]) + self.distinct - numbered + 1


def lexicon(counts: DataFrame, known: int, frequent_rows: int = FREQUENT_ROWS) -> Lexicon:
    total, distinct, ends = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)),
        F.count(F.lit(1)),
        F.coalesce(F.sum(F.when(F.col("w") == END, F.col("c"))), F.lit(0)),
    ).first()
    top = most_frequent(counts.where(F.col("w") != END), "c", frequent_rows)
    top.sort(key=lambda r: (-r["c"], r["w"]))
    words = np.array([r["w"] for r in top], np.int64).view(np.uint64)
    count = np.array([r["c"] for r in top], np.int64)
    known = min(known, gru.CLASS_SIZE * -(-(len(words) + 1) // gru.CLASS_SIZE))
    token = np.minimum(np.arange(1, len(words) + 1), known)
    token_counts = np.zeros(known + 1, np.int64)
    token_counts[0] = ends
    np.add.at(token_counts, token[token < known], count[token < known])
    token_counts[known] = total - token_counts[:known].sum()
    order = np.argsort(words)
    return Lexicon(words[order], count[order], token[order], ends, known, total, distinct, token_counts)


def _encode(rows: pa.RecordBatch, finder: Finder, lex: Lexicon):
    """Words, their places in the lexicon, and the token stream with its row starts and sizes."""
    found = Words(rows.column("text"))
    place = finder.find(found.hashes)
    token = np.where(place >= 0, lex.token[place] if len(lex.token) else lex.known, lex.known)
    stream = np.insert(token, found.first[1:], 0)
    size = np.diff(found.first) + 1
    return found, place, stream, np.cumsum(size) - size, size


def _learn(shared, how: Settings, round_: int):
    def run(batches):
        lex, flat = opened(shared)
        finder = Finder(lex.keys)
        model = gru.Model.of_flat(flat, how.hidden, lex.known)
        trainer = gru.Trainer(model, how.rate / (1 + round_), how.group)
        for rows in chunks(batches, 1 << 22, "text"):
            _, _, stream, first, size = _encode(rows, finder, lex)
            trainer.learn(stream, first, size)
        if trainer.tokens:
            flat = model.flat()
            blocks = range(0, len(flat), PARAMETER_BLOCK)
            weighted = [(flat[a : a + PARAMETER_BLOCK].astype(np.float64) * trainer.tokens).tobytes() for a in blocks]
            many = len(weighted)
            yield batch(PARAMETERS, np.arange(many, dtype=np.int32), np.full(many, float(trainer.tokens)), weighted)

    return run


def _sum_blocks(batches):
    total: dict[int, tuple[float, np.ndarray]] = {}
    for rows in batches:
        for block, weight, value in zip(*(rows.column(c).to_pylist() for c in PARAMETERS.names)):
            w, v = total.get(block, (0.0, 0.0))
            total[block] = (w + weight, v + np.frombuffer(value, np.float64))
    if total:
        keys = sorted(total)
        yield batch(PARAMETERS, keys, [total[k][0] for k in keys], [total[k][1].tobytes() for k in keys])


def rows_of_round(texts: DataFrame, how: Settings, round_: int) -> DataFrame:
    """The training rows of one round. Copies of a text under other ids fall into other parts."""
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(how.parts))
    return texts.where(part == round_ % how.parts).select("text")


def train(texts: DataFrame, lex: Lexicon, how: Settings) -> np.ndarray:
    """Parameters after all rounds. What comes to the driver is one model per round."""
    spark = texts.sparkSession
    flat = gru.fresh(lex.token_counts, how.hidden).flat()
    ddl = "block int, weight double, value binary"
    for round_ in range(how.rounds):
        shared = shipped(spark, (lex, flat))
        learnt = rows_of_round(texts, how, round_).mapInArrow(_learn(shared, how, round_), ddl)
        summed = learnt.repartition("block").mapInArrow(_sum_blocks, ddl).collect()
        if summed:
            summed.sort(key=lambda r: r["block"])
            flat = np.concatenate([np.frombuffer(bytes(r["value"])) / r["weight"] for r in summed]).astype(np.float32)
    return flat


def _score(shared, hidden: int):
    """(0, document with the part of its scores that the task knows) and (1, word to look up)."""

    def run(batches):
        lex, flat = opened(shared)
        finder = Finder(lex.keys)
        model = gru.Model.of_flat(flat, hidden, lex.known)
        plus_one = np.log10(lex.count + 1.0)
        all_total, rare_total = np.log10(lex.total + lex.distinct + 1.0), np.log10(float(lex.rare_total))
        key = TaskContext.get().partitionId() << 33
        for rows in chunks(batches, 1 << 24, "text"):
            found, place, stream, first, size = _encode(rows, finder, lex)
            owner = found.row_of_word()
            many = rows.num_rows
            here = place >= 0
            counted = np.where(here, plus_one[place] if len(plus_one) else 0.0, 0.0)
            other = np.where(here, lex.token[place] == lex.known if len(lex.token) else True, True)
            base = np.bincount(owner, counted, many) + np.log10(lex.ends + 1.0) - size * all_total
            log_p = gru.log_likelihood(model, stream, first, size) / np.log(10.0)
            log_p += np.bincount(owner, np.where(other, counted - rare_total, 0.0), many)
            known = np.bincount(owner, here, many).astype(np.int64) + (lex.ends > 0)
            keys = key + np.arange(many)
            key += many
            none_i, none_f = pa.nulls(many, pa.int64()), pa.nulls(many, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(many, np.int32)), pa.array(keys), rows.column("doc_id"), rows.column("held_out")]
                + [pa.array(size), pa.array(known), pa.array(base), pa.array(log_p), none_i, none_f],
                schema=SCORED,
            )
            words, owner = found.hashes[~here], owner[~here]
            order = np.lexsort((words, owner))
            words, owner = words[order], owner[order]
            new = np.ones(len(words), bool)
            new[1:] = (words[1:] != words[:-1]) | (owner[1:] != owner[:-1])
            at = np.flatnonzero(new)
            often = np.diff(np.append(at, len(words))).astype(np.int32)
            n = len(at)
            ints, floats = pa.nulls(n, pa.int64()), pa.nulls(n, pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(n, np.int32)), pa.array(keys[owner[at]]), ints, pa.nulls(n, pa.bool_())]
                + [ints, ints, floats, floats, pa.array(signed(words[at])), pa.array(often)],
                schema=SCORED,
            )

    return run


def score_documents(
    docs: DataFrame, how: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Learns from rows whose crc32 of the id's decimal text is not 2 modulo 7; a null id is not
    held out. A text has its words and one end; null, empty and blank texts have the end alone. ``n_known``
    counts the tokens that occur in training, ``train_tokens`` is the number of all
    training tokens, ``base_score`` the log10 probability under the smoothed unigram model and
    ``score`` that under the recurrent one, over the whole text. Without a training row both models are
    uniform over what they know. Repeated rows and ids are scored one by one; other columns
    are ignored. Words are told apart by 64-bit hashes.
    """
    spark = prepare(docs.sparkSession)
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(fold_of(F.col(id_col), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    training = texts.where(~F.col("held_out"))
    counts = training.select("text").mapInArrow(_count, "w bigint, c bigint")
    counts = stored(counts.groupBy("w").agg(F.sum("c").alias("c")), "counts")
    lex = lexicon(counts, how.known)
    shared = shipped(spark, (lex, train(training, lex, how)))
    rows = stored(texts.mapInArrow(_score(shared, how.hidden), SCORED_DDL), "scored")
    looked_up = (
        rows.where("kind = 1")
        .select("key", "w", "many")
        .join(counts, "w", "left")
        .groupBy("key")
        .agg(
            F.sum(F.col("many") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("more"),
            F.sum(F.when(F.col("c").isNotNull(), F.col("many")).otherwise(0)).alias("also_known"),
        )
    )
    more = F.coalesce("more", F.lit(0.0))
    # The words looked up here belong to the class of other words, in either model.
    found = rows.where("kind = 0").drop("w", "many").join(looked_up, "key", "left")
    return found.select(
        F.col("doc_id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("also_known", F.lit(0))).alias("n_known"),
        F.lit(lex.total).cast("bigint").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("model") + more).alias("score"),
    )
