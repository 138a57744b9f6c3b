"""Alignment of two tokenizers' tokens over whole texts, with corpus-wide counts of linked ids.

First pass: texts are encoded, their ids are stored (some four bytes a token), documents are aligned, and
each task reports the pairs of ids that it saw linked with the number of its documents that hold
them. The distinct pairs are dealt into parts of bounded
size by hash, and a minimal perfect hash numbers the pairs of each part. The reported numbers are
added into dense vectors, one per part, indexed by that hash, and the vectors are summed up in a
tree. Second pass: documents are aligned again, from their ids, and look their pairs up, comparing
the stored key.

What a task holds for a look-up is a block of parts of bounded size. With more pairs than one
block holds there is one pass over the stored ids per block, and their sums are added up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapharbor.llm.bytebpe import ByteBpe, byte_ranks
from snapharbor.llm.perfecthash import PerfectHash
from snapharbor.llm.shared import batch, chunks, opened, prepare, shipped, stored
from snapharbor.llm.textbytes import mix

# Pairs of a part, on average, and parts whose hash, keys and counts are broadcast together (20 bytes
# a pair at most: some 40 MB).
PART_PAIRS = 1 << 16
BLOCK_PARTS = 32
# Distinct pairs that a task of the first pass holds before it reports them.
HELD_PAIRS = 1 << 21
# Dense vectors that a task adds up before it passes them on (64 MB).
HELD_VECTORS = 128
# Branches of the tree below each part's root.
BRANCHES = 8
SLICES = 1 << 16

# A document's ids (kind 0) or a pair that a task has seen linked in n documents (kind 1).
FIRST = pa.schema(
    [("kind", pa.int32()), ("id", pa.int64()), ("a", pa.binary()), ("b", pa.binary())]
    + [("pair", pa.int64()), ("slice", pa.int32()), ("n", pa.int64())]
)
FIRST_DDL = "kind int, id bigint, a binary, b binary, pair bigint, slice int, n bigint"
HASHES = pa.schema([("part", pa.int32()), ("hash", pa.binary()), ("pairs", pa.binary())])
VECTORS = pa.schema([("part", pa.int32()), ("branch", pa.int32()), ("counts", pa.binary())])
BEST = pa.schema([("a", pa.int32()), ("n", pa.int64())])
VECTORS_DDL = "part int, branch int, counts binary"
LINK = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("count", pa.int64())])
ALIGNED = pa.schema(
    [("id", pa.int64()), ("row", pa.int64())]
    + [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    + [("groups", pa.string()), ("links", pa.list_(LINK))]
)
SUMS = ["n_best", "count_sum"]
ALIGNED_DDL = (
    "id bigint, row bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
    "count_sum bigint, groups string, links array<struct<a: int, b: int, count: bigint>>"
)


class Tokenizers:
    """Both tokenizers with the bytes of each of their ids."""

    def __init__(self, vocabulary: str, model: bytes):
        import sentencepiece

        self.a = ByteBpe(vocabulary)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        known = {number: token for token, number in self.a.ranks.items()}
        known |= {number: token.encode() for token, number in self.a.special.items()}
        self.a_bytes = [known.get(k, b"") for k in range(max(known) + 1)]
        self.b_bytes = [self._piece(k) for k in range(self.b.get_piece_size())]
        self.a_sizes = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(t) for t in self.b_bytes], np.int64)
        # each id as text, not last and last in its group
        a = [t for k in range(len(self.a_bytes)) for t in (f"{k},", f"{k}|")]
        b = [t for k in range(len(self.b_bytes)) for t in (f"{k},", f"{k};")]
        self.names = np.array(a + b, object)

    def _piece(self, k: int) -> bytes:
        piece = self.b.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(k) else piece.replace("▁", " ").encode()

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a text by both; none if either does not spell the blank and the text.

        The ids of A are a partition of the bytes, so their number tells; those of B may spell
        other bytes than they were made from.
        """
        none = np.zeros(0, np.int64)
        if not text:
            return none, none
        line = " " + text
        want = line.encode()
        b = self.b.encode(text)
        if b"".join(map(self.b_bytes.__getitem__, b)) != want:
            return none, none
        a = self.a.plain(line)
        if int(self.a_sizes[a].sum()) != len(want):
            return none, none
        return a, np.array(b, np.int64)

    @property
    def kind(self) -> str:
        """How an id is stored."""
        return "<u2" if max(len(self.a_bytes), len(self.b_bytes)) <= 1 << 16 else "<u4"


def stored_ids(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of stored ids, one after the other, and how many each row has."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = data.to_pybytes()[offsets[0] : offsets[-1]] if data is not None else b""
    return np.frombuffer(whole, kind).astype(np.int64), np.diff(offsets) // int(kind[-1])


class Links:
    """The aligned texts of a batch. Texts follow each other, so all places are of one line of bytes.

    ``a`` and ``b`` are the linked ids in order, ``row`` the text of each link: every byte range between two
    neighbouring token ends lies in one token of each side, and two tokens overlap in one such range.
    """

    def __init__(self, ids_a: np.ndarray, n_a: np.ndarray, ids_b: np.ndarray, n_b: np.ndarray, tokenizers: Tokenizers):
        self.rows, self.ids_a, self.n_a, self.ids_b, self.n_b = len(n_a), ids_a, n_a, ids_b, n_b
        self.ends_a = np.cumsum(tokenizers.a_sizes[self.ids_a])
        self.ends_b = np.cumsum(tokenizers.b_sizes[self.ids_b])
        both = np.concatenate([self.ends_a, self.ends_b])
        both.sort(kind="stable")
        again = both[1:] == both[:-1]
        self.common = both[1:][again]
        edges = both[np.concatenate([np.ones(min(len(both), 1), bool), ~again])]
        self.at_a, self.at_b = np.searchsorted(self.ends_a, edges), np.searchsorted(self.ends_b, edges)
        self.a, self.b = self.ids_a[self.at_a], self.ids_b[self.at_b]
        self.row = np.repeat(np.arange(self.rows), self.n_a)[self.at_a]

    def groups(self, tokenizers: Tokenizers) -> tuple[np.ndarray, list[str]]:
        """Number of groups of each text, and ``a1,a2|b1;a3|b2,b3`` of their ids."""
        group_a, group_b = np.searchsorted(self.common, self.ends_a), np.searchsorted(self.common, self.ends_b)
        size_a, size_b = np.bincount(group_a, minlength=len(self.common)), np.bincount(group_b, minlength=len(self.common))
        before_a, before_b = np.cumsum(size_a), np.cumsum(size_b) - size_b
        order = np.zeros(len(self.ids_a) + len(self.ids_b), np.int64)
        order[np.arange(len(self.ids_a)) + before_b[group_a]] = 2 * self.ids_a + (np.arange(1, len(self.ids_a) + 1) == before_a[group_a])
        last_b = np.arange(1, len(self.ids_b) + 1) == np.cumsum(size_b)[group_b]
        order[np.arange(len(self.ids_b)) + before_a[group_b]] = 2 * (self.ids_b + len(tokenizers.a_bytes)) + last_b
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        texts = ["".join(tokenizers.names[order[a:b]].tolist())[:-1] for a, b in zip([0, *ends], ends)]
        row = np.repeat(np.arange(self.rows), self.n_a)
        closing = np.flatnonzero(np.append(group_a[1:] != group_a[:-1], True)) if len(group_a) else group_a
        return np.bincount(row[closing], minlength=self.rows), texts


def slice_of(pair: np.ndarray) -> np.ndarray:
    return (mix(pair.astype(np.uint64)) >> np.uint64(48)).astype(np.int32)


def _first_pass(files):
    """The ids of each document, and (pair, slice, documents) of what a task saw."""

    def report(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        pair, n = _added(held)
        for at in range(0, len(pair), 1 << 17):
            some = pair[at : at + (1 << 17)]
            none = [None] * len(some)
            yield batch(FIRST, [1] * len(some), none, none, none, some, slice_of(some), n[at : at + (1 << 17)])

    def run(batches):
        tokenizers = Tokenizers(*files.value)
        width = len(tokenizers.b_bytes)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for rows in chunks(batches, 1 << 20, "text"):
            ids = [tokenizers.encode(text) for text in rows.column("text").to_pylist()]
            sides = [[some.astype(tokenizers.kind) for some in side] for side in zip(*ids)]
            none = [None] * rows.num_rows
            a, b = ([some.tobytes() for some in side] for side in sides)
            yield batch(FIRST, [0] * rows.num_rows, rows.column("id"), a, b, none, none, none)
            whole = [(np.concatenate(side).astype(np.int64), np.array([len(x) for x in side])) for side in sides]
            found = Links(*whole[0], *whole[1], tokenizers)
            # once a document
            bits = max(found.rows - 1, 1).bit_length()
            once = np.unique((found.a * width + found.b) << bits | found.row) >> bits
            held.append(np.unique(once, return_counts=True))
            size += len(held[-1][0])
            if size >= HELD_PAIRS:
                held = [_added(held)]
                size = len(held[0][0])
                if size >= HELD_PAIRS // 2:
                    yield from report(held)
                    held, size = [], 0
        if held:
            yield from report(held)

    return run


def _added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pair, n = (np.concatenate(c) for c in zip(*held))
    order = np.argsort(pair, kind="stable")
    pair, n = pair[order], n[order]
    new = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, np.int64)
    return pair[new], np.add.reduceat(n, new) if len(new) else n[:0]


def _runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Rows with equal values of ``names``, which follow each other, as (values, other columns)."""
    key, held = None, {}
    for rows in batches:
        table = rows.to_pydict()
        others = [c for c in table if c not in names]
        for k in range(rows.num_rows):
            now = tuple(table[c][k] for c in names)
            if now != key:
                if key is not None:
                    yield key, held
                key, held = now, {c: [] for c in others}
            for c in others:
                held[c].append(table[c][k])
    if key is not None:
        yield key, held


def _hashed(batches):
    """Rows (part, pair), sorted, to the perfect hash and the pairs, by index, of each part."""
    for (part,), rows in _runs(batches, ["part"]):
        pairs = np.array(rows["pair"], np.int64)
        hash_ = PerfectHash.of(pairs.view(np.uint64))
        by_index = np.zeros(len(pairs), np.int64)
        by_index[hash_.index(pairs)] = pairs
        yield batch(HASHES, [part], [hash_.to_bytes()], [by_index.tobytes()])


class Block:
    """Parts of the pairs from ``first`` on: hash, pairs and, if known, counts of each."""

    def __init__(self, first: int, parts: int, rows: list[tuple[int, bytes, bytes, bytes | None]]):
        self.first, self.parts, self.rows = first, parts, rows

    def open(self) -> Block:
        self.hash = {part: PerfectHash.from_bytes(data) for part, data, _, _ in self.rows}
        self.pairs = {part: np.frombuffer(pairs, np.int64) for part, _, pairs, _ in self.rows}
        self.counts = {part: np.frombuffer(c, np.int64) for part, _, _, c in self.rows if c is not None}
        return self

    def found(self, pair: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(part, places in ``pair``, indexes): the pairs that this block has, keys verified."""
        part = part_of(slice_of(pair).astype(np.int64), self.parts)
        order = np.argsort(part, kind="stable")
        numbers, starts = np.unique(part[order], return_index=True)
        for number, a, b in zip(numbers.tolist(), starts.tolist(), [*starts[1:].tolist(), len(order)]):
            if number not in self.hash:
                continue
            at = order[a:b]
            index = self.hash[number].index(pair[at])
            own = (index >= 0) & (self.pairs[number][np.maximum(index, 0)] == pair[at])
            yield number, at[own], index[own]


def part_of(slice_, parts: int):
    """Slices are hash values, dealt in order to the parts."""
    return slice_ * parts // SLICES


def _vectors(block):
    """Rows (pair, n) added into dense vectors by part, one leaf of the tree a task."""

    def report(held: dict[int, np.ndarray], branch: int) -> pa.RecordBatch:
        many = len(held)
        return batch(VECTORS, list(held), [branch] * many, [v.tobytes() for v in held.values()])

    def run(batches):
        from pyspark import TaskContext

        known = opened(block).open()
        branch = TaskContext.get().partitionId() % BRANCHES
        held: dict[int, np.ndarray] = {}
        for rows in batches:
            pair, n = rows.column("pair").to_numpy(), rows.column("n").to_numpy()
            for part, at, index in known.found(pair):
                if part not in held:
                    if len(held) >= HELD_VECTORS:
                        yield report(held, branch)
                        held = {}
                    held[part] = np.zeros(len(known.pairs[part]), np.int64)
                np.add.at(held[part], index, n[at])
        if held:
            yield report(held, branch)

    return run


def _summed(names: list[str]):
    """Vectors with equal ``names``, which follow each other, added up."""

    def run(batches):
        key, total = None, None
        for rows in batches:
            keys = list(zip(*(rows.column(c).to_pylist() for c in names)))
            for now, data in zip(keys, rows.column("counts")):
                values = np.frombuffer(data.as_buffer(), np.int64)
                if now == key:
                    total = total + values
                    continue
                if key is not None:
                    yield batch(VECTORS, [key[0]], [key[-1]], [total.tobytes()])
                key, total = now, values
        if key is not None:
            yield batch(VECTORS, [key[0]], [key[-1]], [total.tobytes()])

    return run


def _highest(width: int):
    """The highest count of each first id, by part."""

    def run(batches):
        for rows in batches:
            for pairs, counts in zip(rows.column("pairs"), rows.column("counts")):
                a = np.frombuffer(pairs.as_buffer(), np.int64) // width
                n = np.frombuffer(counts.as_buffer(), np.int64)
                order = np.lexsort((n, a))
                last = np.flatnonzero(np.append(a[order][1:] != a[order][:-1], True)) if len(a) else order
                yield batch(BEST, a[order][last], n[order][last])

    return run


def _aligned(files, block, best, with_groups: bool, with_links: bool):
    """Second pass: the alignment of each text and what this block says of its links."""

    def run(batches):
        tokenizers, known = Tokenizers(*files.value), opened(block).open()
        highest = best.value
        width = len(tokenizers.b_bytes)
        for rows in chunks(batches, 1 << 20, "a"):
            sides = [stored_ids(rows.column(c), tokenizers.kind) for c in ("a", "b")]
            found = Links(*sides[0], *sides[1], tokenizers)
            pair, place = np.unique(found.a * width + found.b, return_inverse=True)
            of_pair = np.zeros(len(pair), np.int64)
            for part, at, index in known.found(pair):
                of_pair[at] = known.counts[part][index]
            count = of_pair[place]
            n_links = np.bincount(found.row, minlength=found.rows)
            sums = np.zeros(found.rows, np.int64)
            np.add.at(sums, found.row, count)
            n_best = np.bincount(found.row[(count > 0) & (count == highest[found.a])], minlength=found.rows)
            n_groups, groups = found.groups(tokenizers) if with_groups else ([None] * found.rows, [None] * found.rows)
            links = [None] * found.rows
            if with_links:
                ends = np.cumsum(n_links)
                links = [
                    [{"a": x, "b": y, "count": n} for x, y, n in zip(found.a[e - k : e].tolist(), found.b[e - k : e].tolist(), count[e - k : e].tolist()) if n]
                    for e, k in zip(ends.tolist(), n_links.tolist())
                ]
            yield batch(
                ALIGNED, rows.column("id"), rows.column("row"), found.n_a, found.n_b, n_groups, n_links, n_best, sums, groups, links
            )

    return run


def align(
    docs: DataFrame,
    vocabulary: str | None = None,
    pieces: str | None = None,
    with_links: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups).

    ``vocabulary`` is a byte-level BPE file (A), ``pieces`` a sentencepiece model (B), both by
    path on the driver and broadcast, some 2 MB; by default the public ones. A blank and the text are
    encoded, special tokens' strings as plain text. ``groups`` are the ids between byte offsets at which
    tokens of both end, as ``a1,a2|b1;a3|b2,b3``. A link is a token of A and one of B whose byte ranges
    overlap; the count of two ids is the number of documents in which they are linked. ``n_best`` are the
    links whose count is the highest of their A id (ties included), ``count_sum`` adds up the
    counts of all links. With ``with_links``, ``links`` lists (a, b, count) in text order; beyond one block of
    pairs, block by block.

    Null and empty texts, and texts that either tokenizer does not spell byte for byte, have no
    tokens: zeros and an empty string. Repeated rows and ids are documents of their own, null ids
    stay, other columns are ignored. An empty table gives no rows.
    """
    spark = prepare(docs.sparkSession)
    with open(vocabulary or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        content = f.read()
    with open(pieces or public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    files = spark.sparkContext.broadcast((content, model))
    ranks, special = byte_ranks(content)
    width = _piece_count(model)
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))

    first_pass = stored(texts.mapInArrow(_first_pass(files), FIRST_DDL), "ids")
    ids = first_pass.where("kind = 0").select("id", "a", "b")
    seen = first_pass.where("kind = 1").select("pair", "slice", "n")
    distinct = stored(seen.groupBy("pair", "slice").agg(F.count(F.lit(1)).alias("tasks")), "pairs")
    parts = max(1, -(-distinct.count() // PART_PAIRS))
    part = F.expr(f"cast(cast(slice as bigint) * {parts} div {SLICES} as int)")
    sorted_pairs = distinct.select(part.alias("part"), "pair").repartition("part").sortWithinPartitions("part", "pair")
    hashes = stored(sorted_pairs.mapInArrow(_hashed, "part int, hash binary, pairs binary"), "hashes")

    blocks = [(first, min(first + BLOCK_PARTS, parts)) for first in range(0, parts, BLOCK_PARTS)]
    sums = None
    for first, end in blocks:
        rows = hashes.where(F.col("part").between(first, end - 1)).collect()  # a block: bounded
        block = shipped(spark, Block(first, parts, [(r.part, bytes(r.hash), bytes(r.pairs), None) for r in rows]))
        of_block = seen.where(part.between(first, end - 1)).select("pair", "n")
        leaves = of_block.mapInArrow(_vectors(block), VECTORS_DDL)
        limbs = leaves.repartition("part", "branch").sortWithinPartitions("part", "branch")
        limbs = limbs.mapInArrow(_summed(["part", "branch"]), VECTORS_DDL)
        roots = limbs.repartition("part").sortWithinPartitions("part").mapInArrow(_summed(["part"]), VECTORS_DDL)
        roots = stored(roots.select("part", "counts"), "counts")
        sums = roots if sums is None else sums.unionByName(roots)
    counted = stored(hashes.join(sums, "part"), "counted")
    highest = counted.select("pairs", "counts").mapInArrow(_highest(width), "a int, n bigint")
    best = np.zeros(max([*ranks.values(), *special.values()]) + 1, np.int64)
    for r in highest.groupBy("a").agg(F.max("n").alias("n")).collect():  # at most one row per id of A
        best[r.a] = r.n
    best = spark.sparkContext.broadcast(best)

    if len(blocks) > 1:
        ids = stored(ids.withColumn("row", F.monotonically_increasing_id()), "rows")
    else:
        ids = ids.withColumn("row", F.lit(None).cast("bigint"))
    out = None
    for number, (first, end) in enumerate(blocks):
        rows = counted.where(F.col("part").between(first, end - 1)).collect()  # a block: bounded
        block = shipped(
            spark, Block(first, parts, [(r.part, bytes(r.hash), bytes(r.pairs), bytes(r.counts)) for r in rows])
        )
        found = ids.mapInArrow(_aligned(files, block, best, number == 0, with_links), ALIGNED_DDL)
        out = found if out is None else out.unionByName(found)
    if len(blocks) > 1:
        once = [F.max(c).alias(c) for c in ("id", "n_a", "n_b", "n_groups", "n_links", "groups")]
        added = [F.sum(c).alias(c) for c in SUMS]
        listed = F.flatten(F.collect_list("links")).alias("links")
        out = out.groupBy("row").agg(*once, *added, listed)
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"] + ["links"] * with_links
    return out.select(F.col("id").alias(id_col), *columns)


def _piece_count(model: bytes) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model).get_piece_size()
