"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items that share a run of ``least`` tokens (a seed) are tiled: the
longest common runs that do not overlap are marked again and again, found by running
Karp-Rabin hashes, until none of ``least`` tokens is left. The tiles need not be in the same order
on both sides, so passages whose parts were moved around are caught as well. An item leaks into
a document if its tiles cover a given share of its tokens; the document is contaminated if they
also hold a least number of tokens. Below that a phrase that anyone might write would do ("yes", or half of
"what is the capital of France today"): such leaks are listed, but no document goes for them.

A token is a run of letters and digits; A-Z are lower-cased. Marks and spaces of all scripts part
tokens, and each character of a script without spaces is a token.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapharbor.llm.shared import batch, chunks, opened, prepare, shipped
from snapharbor.llm.textbytes import Words, ngrams, segmented, segmenting

LEAST = 4
COVERAGE = 0.5
# Tokens under tiles from which a leak tells something about the document.
MATCHED = 8
# Benchmark tokens that are held by every task at a time; more are taken in several passes.
BLOCK_TOKENS = 2_000_000
FIRST_SEARCH = 20

LEAKS = pa.schema(
    [("row", pa.int64()), ("item_id", pa.int64()), ("coverage", pa.float64()), ("matched", pa.int32())]
    + [("tiles", pa.int32()), ("longest", pa.int32()), ("tile_spans", pa.list_(pa.int32()))]
)
LEAKS_DDL = "`row` bigint, item_id bigint, coverage double, matched int, tiles int, longest int, tile_spans array<int>"
_MODULUS = (1 << 61) - 1
_RADIX = 0x1F3D5B79A2C4E681 % _MODULUS


def _runs(free: list[bool], size: int):
    """(start, end) of the runs of unmarked places that hold ``size`` tokens."""
    start = None
    for i, ok in enumerate([*free, False]):
        if ok and start is None:
            start = i
        elif not ok and start is not None:
            if i - start >= size:
                yield start, i
            start = None


def _rolling(tokens: list[int], free: list[bool], size: int):
    """(place, Karp-Rabin hash) of each unmarked window of ``size`` tokens."""
    drop = pow(_RADIX, size - 1, _MODULUS)
    for start, end in _runs(free, size):
        value = 0
        for i in range(start, end):
            if i - start >= size:
                value = (value - tokens[i - size] * drop) % _MODULUS
            value = (value * _RADIX + tokens[i]) % _MODULUS
            if i - start >= size - 1:
                yield i - size + 1, value


def _matches(a, b, free_a, free_b, size):
    """Longest unmarked matches from each pair of equal windows, as (length, place a, place b).

    Stops early, with only a length, when one is over twice as long as the search size.
    """
    windows = defaultdict(list)
    for j, value in _rolling(b, free_b, size):
        windows[value].append(j)
    found = []
    for i, value in _rolling(a, free_a, size):
        for j in windows.get(value, ()):
            if i and j and free_a[i - 1] and free_b[j - 1] and a[i - 1] == b[j - 1]:
                continue  # inside a match that began earlier
            n = 0
            while (
                i + n < len(a) and j + n < len(b) and free_a[i + n] and free_b[j + n] and a[i + n] == b[j + n]
            ):
                n += 1
            if n > 2 * size:
                return n, []
            if n >= size:
                found.append((n, i, j))
    return 0, found


def tiles(a: list[int], b: list[int], free_a: list[bool], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two token lists: (length, place in a, place in b).

    ``free_a`` is False where a cannot match. Of equally long matches the first in a, then in b, wins.
    """
    free_a, free_b = list(free_a), [True] * len(b)
    out = []
    size = max(least, FIRST_SEARCH)
    while True:
        longer, found = _matches(a, b, free_a, free_b, size)
        if longer:
            size = longer
            continue
        queue = defaultdict(list)
        for n, i, j in found:
            queue[n].append((i, j))
        while queue:
            n = max(queue)
            for i, j in sorted(queue.pop(n)):
                # what other tiles have left of it: unmarked runs go back into the queue
                whole = [free_a[i + k] and free_b[j + k] for k in range(n)]
                if all(whole):
                    for k in range(n):
                        free_a[i + k] = free_b[j + k] = False
                    out.append((n, i, j))
                else:
                    for s, e in _runs(whole, size):
                        queue[e - s].append((i + s, j + s))
        if size == least:
            return out
        size = max(least, size // 2)


class Index:
    """Benchmark items and where their seeds are."""

    def __init__(self, items: list[tuple[int, str | None]], least: int):
        self.patterns = segmenting()
        texts = pa.array([text for _, text in items], pa.string())
        found = Words(segmented(texts, self.patterns), marks=True)
        self.ids = [item_id for item_id, _ in items]
        self.tokens = [found.hashes[found.first[i] : found.first[i + 1]] for i in range(len(items))]
        self.least = [min(least, len(t)) for t in self.tokens]
        places = defaultdict(set)
        for i, tokens in enumerate(self.tokens):
            if len(tokens):
                for seed in ngrams(tokens, self.least[i]).tolist():
                    places[self.least[i], seed].add(i)
        self.sizes = sorted({n for n, _ in places})
        self.seeds, self.items = {}, {}
        for n in self.sizes:
            own = {seed: sorted(v) for (m, seed), v in places.items() if m == n}
            self.seeds[n] = np.array(sorted(own), np.uint64)
            self.items[n] = [own[s] for s in self.seeds[n].tolist()]


def leaked_items(index: Index, column: pa.Array, coverage: float) -> list[tuple]:
    """(row, item id, coverage, matched tokens, tiles, longest, spans) of items that leaked into some texts."""
    found = Words(segmented(column, index.patterns), marks=True)
    row_of = found.row_of_word()
    hits = defaultdict(list)  # (row, item): places of seeds
    for n in index.sizes:
        windows = ngrams(found.hashes, n)
        at = np.minimum(np.searchsorted(index.seeds[n], windows), len(index.seeds[n]) - 1)
        met = np.flatnonzero((index.seeds[n][at] == windows) & (row_of[n - 1 :] == row_of[: len(windows)]))
        for place, k in zip(met.tolist(), at[met].tolist()):
            for item in index.items[n][k]:
                hits[int(row_of[place]), item].append(place)
    out = []
    for (i, item), places in hits.items():
        tokens, least = index.tokens[item], index.least[item]
        # Only tokens under a seed can match: the others part the runs.
        covered = np.unique((np.array(places)[:, None] + np.arange(least)).ravel())
        gap = np.diff(covered, prepend=covered[0]) > 1
        slot = np.arange(len(covered)) + np.cumsum(gap)
        a = np.zeros(int(slot[-1]) + 1, np.uint64)
        free = np.zeros(len(a), bool)
        a[slot], free[slot] = found.hashes[covered], True
        # At best, each token of the item that occurs at all is covered.
        if np.isin(tokens, a[slot]).sum() < coverage * len(tokens):
            continue
        tiled = tiles((a >> np.uint64(3)).tolist(), (tokens >> np.uint64(3)).tolist(), free.tolist(), least)
        matched = sum(n for n, _, _ in tiled)
        share = matched / len(tokens)
        if share >= coverage:
            real = np.zeros(len(a), np.int64)
            real[slot] = covered - found.first[i]
            spans = [x for n, p, _ in sorted(tiled, key=lambda t: t[1]) for x in (int(real[p]), n)]
            out.append((i, index.ids[item], share, matched, len(tiled), max(n for n, _, _ in tiled), spans))
    return out


def _leaks(shared, coverage: float):
    def run(batches):
        index = opened(shared)
        for rows in chunks(batches, 1 << 21, "text"):
            out = leaked_items(index, rows.column("text"), coverage)
            if out:
                cols = [list(c) for c in zip(*out)]
                yield batch(LEAKS, rows.column("row").take(pa.array(cols[0])), *cols[1:])

    return run


def _clean(shared, coverage: float, matched: int, text_col: str):
    def run(batches):
        index = opened(shared)
        for rows in chunks(batches, 1 << 21, text_col):
            keep = np.ones(rows.num_rows, bool)
            keep[[x[0] for x in leaked_items(index, rows.column(text_col), coverage) if x[3] >= matched]] = False
            yield rows.filter(pa.array(keep))

    return run


def indexes(benchmark: DataFrame, least: int, block_tokens: int):
    """Broadcast indexes of the benchmark's blocks."""
    spark = prepare(benchmark.sparkSession)
    items = benchmark.select(F.col("item_id").cast("bigint"), F.col("text").cast("string")).where("text is not null")
    # a token has at least one byte and one that parts it from the next
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // (2 * block_tokens)))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for k in range(blocks):
        part = [tuple(r) for r in items.where(block == k).orderBy("item_id", "text").collect()]
        yield shipped(spark, Index(part, least))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    least: int = LEAST,
    coverage: float = COVERAGE,
    matched: int = MATCHED,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per document and benchmark item that leaked into it: (doc_id, contaminated,
    item_id, coverage, matched, tiles, longest, tile_spans).

    ``coverage`` is the share of the item's tokens under tiles of at least ``least`` tokens, and
    ``contaminated`` says whether ``matched`` of them or more are; ``longest`` is the longest tile, ``tile_spans`` (first token, tokens) of each tile in the document, flat. An item
    with fewer tokens than ``least`` must occur whole. Null, empty and wordless texts leak nothing and
    hold nothing. Repeated documents or items, also with one id, are reported each; null ids stay
    null. Other columns are ignored.

    The benchmark is held by every task in blocks of about ``block_tokens`` tokens; a larger one takes
    several passes over the documents.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("row"), F.col(text_col).cast("string").alias("text"))
    found = None
    for shared in indexes(benchmark, least, block_tokens):
        part = rows.mapInArrow(_leaks(shared, coverage), LEAKS_DDL)
        found = part if found is None else found.unionByName(part)
    named = (F.col("row").alias(id_col), (F.col("matched") >= matched).alias("contaminated"))
    return found.select(*named, "item_id", "coverage", "matched", "tiles", "longest", "tile_spans")


def drop_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    least: int = LEAST,
    coverage: float = COVERAGE,
    matched: int = MATCHED,
    text_col: str = "text",
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """The rows of ``docs`` that no benchmark item has contaminated (see ``leaks``); all columns stay."""
    prepare(docs.sparkSession)
    for shared in indexes(benchmark, least, block_tokens):
        docs = docs.mapInArrow(_clean(shared, coverage, matched, text_col), docs.schema)
    return docs
