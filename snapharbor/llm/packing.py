"""Best-fit packing of token pieces into sequences of a fixed length.

Rounds are bulk-synchronous. Each one sorts the pieces that are left and the gaps of the
open sequences by size and sweeps both from large to small: a piece takes the smallest gap
that still holds it, a gap takes one piece a round, and of the pieces that want one gap
the first by rank gets it. Then the gaps shrink and the next round begins; when nothing fits
any more, the largest pieces open new sequences.

Lengths are whole numbers up to the sequence length, so a sorted run of equal lengths is
one entry with a count. A round works on such runs, at most one per length whatever
the number of documents, and yields assignments "ranks a to b of length l go to sequences
from s on, at offset o". The documents themselves are range-sorted by length on the
cluster, where each task ranks its part and sweeps it along the assignments.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapharbor.llm.bytebpe import ByteBpe
from snapharbor.llm.shared import batch, prepare, stored

CAPACITY = 2048
END_ID = 0

PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]
    + [("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32()))]
)
PIECES_DDL = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids array<int>"
_LOW = (1 << 33) - 1  # monotonically_increasing_id: partition above, row below


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be short."""
    head = length % capacity
    sizes = ([head] if head else []) + [capacity] * (length // capacity)
    starts = np.cumsum([0, *sizes[:-1]])
    return [(int(s), n) for s, n in zip(starts, sizes)]


def _pieces(vocabulary, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]):
        encode = ByteBpe(vocabulary.value).ids
        for rows in batches:
            out: list[tuple] = []
            for doc_id, text in zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist()):
                ids = np.append(encode(text) if text else np.zeros(0, np.uint32), end_id).astype("<u4")
                for k, (start, length) in enumerate(cuts(len(ids), capacity)):
                    part = ids[start : start + length]
                    kept = part.astype(np.int32) if with_ids else None
                    out.append((doc_id, k, start, length, zlib.crc32(part.tobytes()), kept))
            yield batch(PIECES, *([list(c) for c in zip(*out)] if out else [[]] * 6))

    return run


def best_fit(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Assignments (length, first rank, ranks, first sequence, offset) and the number of
    sequences, for ``counts`` pieces of each length."""
    left = {n: c for n, c in counts.items() if c}
    done: dict[int, int] = defaultdict(int)  # ranks of a length that are placed
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: (first sequence, sequences)
    plan: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def place(length: int, many: int, sequence: int, gap: int) -> None:
        plan.append((length, done[length], many, sequence, capacity - gap))
        done[length] += many
        left[length] -= many
        if not left[length]:
            del left[length]

    def sweep() -> bool:
        """One round: each gap takes at most one piece, the largest that it is best for."""
        nonlocal gaps
        rest: dict[int, list[tuple[int, int]]] = defaultdict(list)
        stack: list[tuple[int, int, int]] = []
        moved = False
        for size in sorted({*left, *gaps}, reverse=True):
            stack.extend((size, first, many) for first, many in gaps.get(size, ()))
            while left.get(size) and stack:
                gap, first, many = stack.pop()
                take = min(many, left[size])
                place(size, take, first, gap)
                moved = True
                if gap > size:
                    rest[gap - size].append((first, take))
                if many > take:
                    stack.append((gap, first + take, many - take))
        for gap, first, many in stack:
            rest[gap].append((first, many))
        gaps = rest
        return moved

    while left:
        # Longer ones than half of a sequence never share one; beyond them, open as many
        # sequences as the tokens that are left must fill.
        need = max(-(-sum(n * c for n, c in left.items()) // capacity), sum(c for n, c in left.items() if 2 * n > capacity))
        for length in sorted(left, reverse=True):
            # one sequence for as many equal pieces as fit in it; the others follow in the sweeps
            many = min(-(-left[length] // (capacity // length)), need)
            if not many:
                break
            place(length, many, opened, capacity)
            if capacity > length:
                gaps[capacity - length].append((opened, many))
            opened += many
            need -= many
        while left and sweep():
            pass
    return plan, opened


def _assign(plan, offsets, capacity: int, fields: pa.Schema):
    """Rank of each piece within its length, and its place by the assignments."""

    def run(batches):
        length, first, sequence, offset = plan.value
        part_keys, part_base = offsets.value
        span = np.int64(capacity + 1)
        # One sorted key over (length, rank): lengths apart by more than any rank.
        wide = np.int64(1) << np.int64(48)
        keys = length * wide + first
        for rows in batches:
            n = rows.column("length").to_numpy()
            place = rows.column("place").to_numpy()
            at = np.searchsorted(part_keys, (place >> 33) * span + n)
            rank = (place & _LOW) + part_base[at]
            hit = np.searchsorted(keys, n * wide + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    *(rows.column(name) for name in fields.names[:-2]),
                    pa.array(sequence[hit] + rank - first[hit], pa.int64()),
                    pa.array(offset[hit], pa.int64()),
                ],
                schema=fields,
            )

    return run


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    vocabulary: str | None = None,
    end_id: int = END_ID,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    ``vocabulary`` is the path, on the driver, of a byte-level BPE file (by default the
    public one); its text is broadcast, some 1.5 MB. With ``with_ids`` the ids of a piece come
    too. A document is its ids and ``end_id``; null and empty texts are ``end_id`` alone.
    Documents longer than ``capacity`` are cut from the end, so that only the first piece may be
    short; nothing else is cut. Rows that repeat, also with one id, are documents of
    their own; a null id stays null. Pieces of one length are ranked by id, piece and checksum,
    so that ties do not change the packing. Other columns are ignored.
    """
    spark = prepare(docs.sparkSession)
    with open(vocabulary or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        content = spark.sparkContext.broadcast(f.read())
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    pieces = texts.mapInArrow(_pieces(content, capacity, end_id, with_ids), PIECES_DDL)
    pieces = stored(pieces if with_ids else pieces.drop("ids"), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # <= capacity rows
    plan, _ = best_fit(counts, capacity)
    plan.sort()

    ranked = pieces.repartitionByRange("length", "doc_id", "piece", "ids_crc32")
    ranked = ranked.sortWithinPartitions("length", "doc_id", "piece", "ids_crc32")
    ranked = stored(ranked.withColumn("place", F.monotonically_increasing_id()), "ranked")
    # One row per length and, for lengths that a border cuts, per partition.
    parts = sorted(
        ranked.groupBy(F.shiftright("place", 33).alias("part"), "length")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.col("place").bitwiseAND(_LOW)).alias("low"))
        .collect(),
        key=lambda r: (r["length"], r["part"]),
    )
    before: dict[int, int] = defaultdict(int)
    base = {}
    for r in parts:
        base[r["part"] * (capacity + 1) + r["length"]] = before[r["length"]] - r["low"]
        before[r["length"]] += r["n"]
    keys = np.array(sorted(base), np.int64)
    offsets = spark.sparkContext.broadcast((keys, np.array([base[k] for k in keys.tolist()], np.int64)))
    length, first, _, sequence, offset = (
        np.array(c, np.int64) for c in (zip(*plan) if plan else [[]] * 5)
    )
    lookup = spark.sparkContext.broadcast((length, first, sequence, offset))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    fields = pa.schema(
        [PIECES.field(name) for name in names] + [("sequence_id", pa.int64()), ("offset", pa.int64())]
    )
    ddl = ", ".join(f"{c} {t}" for c, t in ranked.select(*names).dtypes)
    return ranked.mapInArrow(
        _assign(lookup, offsets, capacity, fields), f"{ddl}, sequence_id bigint, offset bigint"
    )
