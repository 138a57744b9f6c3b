"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints that differ in at most r of 64 bits agree on two of r + 2 blocks of bits at
least, so each pair of blocks is a table in which they share a cell (a bucket of equal
bits). Within sorted cells, fingerprints are stored vertically: plane b holds bit b of 64
of them in a word. The planes are compared with themselves moved by 1, 2, 3 ... places; the
differences of 64 pairs are added up at once, in carry-save counters of a few words that are
preloaded so that they overflow just beyond r. Words whose 64 pairs have all overflowed, lie in
different cells or are linked already are abandoned.

Equal fingerprints are one entry. Cells stay bounded: the entries of a cell that is too large are
split again by the bits that the cell does not fix (of r + 1 parts of them one must agree), and
what is still too large is dealt into squares of chunk against chunk. A cell gives a spanning forest
of its links, not all pairs; connected components over those are the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapharbor.llm.components import components
from snapharbor.llm.shared import batch, chunks, prepare, stored
from snapharbor.llm.textbytes import Words, signed

BITS = 64
SEED = 42
# Entries of a cell that are compared in one task; a square of two chunks has twice as many.
CELL_ENTRIES = 2048
# Entries that are laid out as planes at a time.
HELD = 1 << 17
# Shingles whose hashes are held at a time.
SHINGLES = 1 << 17
# Planes added before finished words are abandoned.
GROUP = 8

PRINTS = pa.schema([("id", pa.int64()), ("print", pa.int64())])
LINKS = pa.schema([("x", pa.int64()), ("y", pa.int64())])


def fingerprint_sums(words: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many of the byte strings at ``starts`` have a hash with bit 0, 1, ... 63 set."""
    sums = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), SHINGLES):
        some = zip(starts[at : at + SHINGLES].tolist(), sizes[at : at + SHINGLES].tolist())
        hashes = np.array([digest(words[a : a + n], SEED) for a, n in some], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums += bits.sum(axis=0, dtype=np.int64)
    return sums


def fingerprints(column: pa.Array, words: int) -> np.ndarray:
    """The fingerprint of each text; 0 without words."""
    found = Words(column)
    # Words with one blank between them: every shingle is a run of these bytes.
    sizes = found.ends - found.starts
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    line = np.full(int((sizes + 1).sum()), 0x20, np.uint8)
    into = np.repeat(begins - found.starts, sizes)
    inside = np.zeros(len(found.data) + 1, np.int8)
    inside[found.starts] += 1
    inside[found.ends] -= 1  # a word may begin where that of the row before ends
    at = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
    line[at + into] = found.data[at]
    content = line.tobytes()
    finishes = begins + sizes
    out = np.zeros(found.rows, np.uint64)
    powers = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
    for i in range(found.rows):
        a, b = int(found.first[i]), int(found.first[i + 1])
        if a == b:
            continue
        n = max(b - a - words + 1, 1)
        last = finishes[b - n : b]
        sums = fingerprint_sums(content, begins[a : a + n], last - begins[a : a + n])
        out[i] = powers[2 * sums > n].sum(dtype=np.uint64)
    return out


def _prints(words: int):
    def run(batches):
        for rows in chunks(batches, 1 << 21, "text"):
            yield batch(PRINTS, rows.column("id"), signed(fingerprints(rows.column("text"), words)))

    return run


def blocks_of(bits: list[int], parts: int) -> list[int]:
    """Masks that deal ``bits`` into ``parts`` runs of about equal length."""
    edges = [len(bits) * k // parts for k in range(parts + 1)]
    return [sum(1 << b for b in bits[a:z]) for a, z in zip(edges, edges[1:])]


def tables(radius: int) -> list[int]:
    """Masks of two of radius + 2 blocks: fingerprints that link agree on one mask at least."""
    return [x | y for x, y in combinations(blocks_of(list(range(BITS)), radius + 2), 2)]


def subtables(mask: int, radius: int) -> list[int]:
    """Masks of the bits outside ``mask``, of which one must agree too."""
    return [mask | part for part in blocks_of([b for b in range(BITS) if not mask >> b & 1], radius + 1)]


def _long(value: int) -> Column:
    return F.lit(value - (1 << 64) if value >> 63 else value).cast("bigint")


def planes(values: np.ndarray, furthest: int) -> np.ndarray:
    """Row b has bit b of all values, 64 to a word; zeros follow, so that the planes can be
    moved by up to ``furthest`` places."""
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    lanes = np.packbits(bits, axis=1, bitorder="little")
    out = np.zeros((BITS, (-(-len(values) // 64) + furthest // 64 + 1) * 8), np.uint8)
    out[:, : lanes.shape[1]] = lanes
    return out.view(np.uint64)


def packed(flags: np.ndarray) -> np.ndarray:
    bits = np.packbits(flags, bitorder="little")
    return np.concatenate([bits, np.zeros(-len(bits) % 8, np.uint8)]).view(np.uint64)


class Counters:
    """Saturating sums of single bits, 64 lanes to a word: lanes beyond ``radius`` are over."""

    def __init__(self, words: int, radius: int):
        size = max(radius.bit_length(), 1)
        # preloaded so that the count just beyond the radius carries out of the last word
        start = (1 << size) - 1 - radius
        ones = np.uint64(0xFFFFFFFFFFFFFFFF)
        self.sums = [np.full(words, ones if start >> k & 1 else 0, np.uint64) for k in range(size)]
        self.over = np.zeros(words, np.uint64)

    def add(self, carry: np.ndarray) -> None:
        for k, held in enumerate(self.sums):
            self.sums[k] = held ^ carry
            carry = held & carry
        self.over |= carry

    def keep(self, at: np.ndarray) -> None:
        self.sums = [held[at] for held in self.sums]
        self.over = self.over[at]


def close_lanes(bits: np.ndarray, asked: np.ndarray, shift: int, radius: int) -> np.ndarray:
    """Lanes i, of those in ``asked``, whose values i and i + shift differ in ``radius`` bits at most."""
    at = np.flatnonzero(asked)
    lanes, counters = asked[at], Counters(len(at), radius)
    q, r = divmod(shift, 64)
    for first in range(0, BITS, GROUP):
        if not len(at):
            break
        group = bits[first : first + GROUP]
        if r:
            moved = (group[:, at + q] >> np.uint64(r)) | (group[:, at + q + 1] << np.uint64(64 - r))
        else:
            moved = group[:, at + q]
        for difference in group[:, at] ^ moved:
            counters.add(difference)
        alive = np.flatnonzero(lanes & ~counters.over)
        if len(alive) < len(at):
            at, lanes = at[alive], lanes[alive]
            counters.keep(alive)
    if not len(at):
        return np.zeros(0, np.int64)
    hits = np.unpackbits((lanes & ~counters.over).view(np.uint8), bitorder="little").reshape(-1, 64)
    word, lane = np.nonzero(hits)
    return at[word] * 64 + lane


def links_in_cells(cells: np.ndarray, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within each cell; ``cells`` is sorted."""
    edges = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1], [True]])) if len(cells) else np.zeros(1, int)
    sizes = np.diff(edges)
    shared = np.repeat(sizes, sizes) > 1  # cells of one entry have no pair
    cells, values = cells[shared], values[shared]
    if not len(cells):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    sizes = sizes[sizes > 1]
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(cells))  # entries from each one to its cell's end
    bits = planes(values, int(sizes.max()))
    root = np.arange(len(cells))
    pairs: list[tuple[int, int]] = []

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for shift in range(1, int(sizes.max())):
        open_ = left > shift
        # pairs that are linked already need no comparison
        open_[: len(root) - shift] &= root[: len(root) - shift] != root[shift:]
        found = close_lanes(bits, packed(open_), shift, radius)
        merged = False
        for i in found.tolist():
            a, b = top(i), top(i + shift)
            if a != b:
                root[max(a, b)] = min(a, b)
                pairs.append((i, i + shift))
                merged = True
        if merged:
            while True:
                flat = root[root]
                if (flat == root).all():
                    break
                root = flat
    if not pairs:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    i, j = np.array(pairs).T
    return values[i], values[j]


def _compared(radius: int):
    """Entries (cell, print), sorted, to links. Whole cells are held, a bounded number of entries."""

    def run(batches: Iterator[pa.RecordBatch]):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for rows in batches:
            if not rows.num_rows:
                continue
            held.append((rows.column("cell").to_numpy(), rows.column("print").to_numpy().view(np.uint64)))
            size += rows.num_rows
            if size < HELD or held[-1][0][0] == held[-1][0][-1]:
                continue
            cells, values = (np.concatenate(c) for c in zip(*held))
            last = int(np.argmax(cells[::-1] != cells[-1]))
            cut = len(cells) - last
            x, y = links_in_cells(cells[:cut], values[:cut], radius)
            yield batch(LINKS, signed(x), signed(y))
            held, size = [(cells[cut:], values[cut:])], last
        if held:
            x, y = links_in_cells(*(np.concatenate(c) for c in zip(*held)), radius)
            yield batch(LINKS, signed(x), signed(y))

    return run


def _celled(prints: DataFrame, masks: list[list[int]], tag: str) -> DataFrame:
    """(print, t, cell): an entry per mask of list t; ``prints`` has t if there are several lists."""
    several = len(masks) > 1

    def mask(k: int) -> Column:
        of_list = [_long(choice[k]) for choice in masks]
        return F.element_at(F.array(*of_list), F.col("t") + 1) if several else of_list[0]

    cells = F.array(
        *(
            F.struct(
                (F.col("t") if several else F.lit(k)).alias("t"),
                F.xxhash64(F.lit(tag), *([F.col("t")] * several), F.lit(k), F.col("print").bitwiseAND(mask(k))).alias("cell"),
            )
            for k in range(len(masks[0]))
        )
    )
    return prints.select("print", F.explode(cells).alias("at")).select("print", "at.t", "at.cell")


def _crowded(entries: DataFrame, most: int, tag: str) -> DataFrame:
    """Cells of more than ``most`` entries, with their sizes."""
    sizes = entries.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"))
    return stored(sizes.where(F.col("rows") > most), tag)


def close_links(prints: DataFrame, radius: int, cell_entries: int | None = None) -> DataFrame:
    """Links (x, y) between the distinct fingerprints ``print`` that connect all pairs of at most
    ``radius`` differing bits; not every such pair is a row."""
    most = CELL_ENTRIES if cell_entries is None else cell_entries
    masks = tables(radius)
    entries = _celled(prints, [masks], "table")

    def apart(rows: DataFrame, large: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Entries of small and of large cells. The second key lets a join split a hot cell."""
        keyed = rows.withColumn("k", F.xxhash64("cell"))
        marked = keyed.join(large.withColumn("k", F.xxhash64("cell")), ["cell", "k"], "left").drop("k")
        return marked.where("rows is null").drop("rows"), marked.where("rows is not null")

    large = _crowded(entries, most, "crowded")
    rows = entries.select("cell", "print")
    if not large.isEmpty():
        small, big = apart(entries, large)
        rows = small.select("cell", "print")
        # The entries of a large cell agree on its mask: split them by the other bits.
        finer = [subtables(mask, radius) for mask in masks]
        split = _celled(big.select("print", "t"), finer, "finer")
        large = _crowded(split, most, "crowded")
        small, big = apart(split, large)
        rows = rows.unionByName(small.select("cell", "print"))
        if not large.isEmpty():
            # Chunk against chunk: every two entries of the cell meet in one square at least.
            parts = F.ceil(F.col("rows") / most).cast("int")
            mine = F.pmod(F.xxhash64("print", F.lit("chunk")), parts).cast("int")
            squares = big.select("cell", "print", mine.alias("i"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("j"))
            square = F.xxhash64("cell", F.least("i", "j"), F.greatest("i", "j"))
            rows = rows.unionByName(squares.select(square.alias("cell"), "print"))
    ordered = rows.repartition("cell").sortWithinPartitions("cell", "print")
    return ordered.mapInArrow(_compared(radius), "x bigint, y bigint")


def simhash_classes(
    docs: DataFrame,
    words: int = 3,
    radius: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: (id, fingerprint, component_id).

    A text is lower-cased (A-Z) and cut into words at 0x20 and 0x09-0x0D; its shingles are all
    runs of ``words`` words, repeats included, joined by a blank (a text with fewer words is one
    shingle). A bit of the fingerprint is 1 if it is set in over half of the shingles' XXH64 hashes (UTF-8, seed
    42); without words, or a null text, the fingerprint is 0, which links like any other. Fingerprints link if at
    most ``radius`` bits differ (0 to 62); ``component_id`` is the smallest id reachable.

    Repeated rows stay, each with its class. A null id takes part: its class has the smallest id
    that is not null, or null if there is none. Other columns are ignored, whatever their names.
    """
    if not 0 <= radius <= BITS - 2:
        raise ValueError("radius must be 0 to 62")
    prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    prints = stored(texts.mapInArrow(_prints(words), "id bigint, print bigint"), "prints")
    distinct = stored(prints.groupBy("print").agg(F.min("id").alias("id")), "distinct")
    links = stored(close_links(distinct.select("print"), radius), "links")
    classes = stored(components(links), "classes")
    rooted = distinct.join(classes.withColumnRenamed("node", "print"), "print", "left")
    rooted = stored(rooted.select("print", "id", F.coalesce("root", "print").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id")).withColumn("k", F.xxhash64("root"))
    # Second keys: both sides shuffle, so that a class or a fingerprint of many rows can be split.
    member = rooted.withColumn("k", F.xxhash64("root")).join(least, ["root", "k"])
    member = stored(member.select("print", "component_id"), "member")
    out = prints.withColumn("k", F.xxhash64("print")).join(member.withColumn("k", F.xxhash64("print")), ["print", "k"])
    return out.select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
