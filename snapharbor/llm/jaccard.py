"""N-gram Jaccard join: which documents share most of their word n-grams.

The documents x n-grams incidence matrix A is never multiplied whole. Each document puts
only the first few of its n-grams, in one global order, into the join: two documents as
similar as asked must share one of those (the prefix bound). The product of these
blocks accumulates, for each pair, the number of shared prefix entries, and a pair goes
on only if the shared entries plus what is left behind the last of them can still
reach the overlap that the two sizes ask for. Survivors are checked on whole sets.

Nothing is quadratic in the size of a group of copies:

* equal sets are one node;
* the order puts n-grams that are common in the corpus last, so that a passage in a third
  of all documents is rarely in a prefix (the order is a hint: any order is exact);
* neighbours and leaders within each list are checked first, a number of pairs linear in
  the entries, and what they link becomes one component. Pairs are multiplied out only
  between different components: the smaller ones of a list against the whole list.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapharbor.llm.components import components
from snapharbor.llm.shared import batch, chunks, most_frequent, prepare, stored
from snapharbor.llm.textbytes import Shingles, mix, signed

# Distinct n-grams counted at a time in a task, and the count from which one is reported.
COUNT_BLOCK = 1 << 22
COUNT_LEAST = 8
# Common n-grams that the order puts last. Only a hint: the bound costs no result.
COMMON_ROWS = 200_000
# Entries of lists that one block of the product holds; a longer list is joined instead.
BLOCK_ENTRIES = 20_000
# Products held before equal pairs are added up.
PRODUCTS = 1 << 20
# Ids of dropped documents up to this many (16 MB) are broadcast.
BROADCAST_IDS = 1 << 20
# Bits of the filter that thins the documents whose sets are needed.
FILTER_BITS = 22

SET_ROWS = pa.schema(
    [("kind", pa.int32()), ("id", pa.int64()), ("n", pa.int64()), ("sig", pa.int64()), ("bits", pa.binary())]
)
ENTRY_ROWS = pa.schema([("s", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("pos", pa.int32())])
LIST_ORDER = ["s", "class", "pos", "n", "node"]
LIST_ROWS = pa.schema(
    [("kind", pa.int32()), ("s", pa.int64()), ("x", pa.int64()), ("n", pa.int32())]
    + [("y", pa.int64()), ("m", pa.int32()), ("pos", pa.int32())]
)
NODE_SETS = pa.schema([("node", pa.int64()), ("grams", pa.binary())])
PAIR_ROWS = pa.schema([(c, pa.int64()) for c in ("x", "y", "x_slot", "y_slot")])
PRODUCT_ROWS = pa.schema(
    [(c, pa.int64()) for c in ("x", "y", "n", "m", "c", "px", "py")]
)
LINK_ROWS = pa.schema([("x", pa.int64()), ("y", pa.int64())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "bigint", pa.binary(): "binary"}
    return ", ".join(f"`{f.name}` {names[f.type]}" for f in schema)


@dataclass(frozen=True)
class Rule:
    """Two sets link if den * intersection >= num * union."""

    words: int
    num: int
    den: int

    def prefix(self, n: int) -> int:
        return n - -(-self.num * n // self.den) + 1


def outline(grams: np.ndarray) -> bytes:
    """A bit per n-gram, two to four times as many bits as n-grams, a power of two."""
    size = max(64, 1 << int(2 * len(grams) - 1).bit_length())
    flags = np.zeros(size, bool)
    flags[grams & np.uint64(size - 1)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def most_shared(a: bytes, n: int, b: bytes, m: int) -> int:
    """An upper bound of the overlap of two sets: an n-gram whose bit the other set lacks is
    not shared. The longer outline is folded to the length of the shorter one."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(x) > len(y):
        x = np.bitwise_or.reduce(x.reshape(-1, len(y)), axis=0)
    elif len(y) > len(x):
        y = np.bitwise_or.reduce(y.reshape(-1, len(x)), axis=0)
    return min(n - int(np.bitwise_count(x & ~y).sum()), m - int(np.bitwise_count(y & ~x).sum()))


def slot_of(node, doc_id) -> np.ndarray:
    """The filter bit of a set's representative: the row with its smallest id."""
    with np.errstate(over="ignore"):
        key = np.asarray(node, np.int64).view(np.uint64) + mix(np.asarray(doc_id, np.int64).view(np.uint64))
    return (mix(key) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")
    )


def _describe(words: int):
    """(0, id, set size, signature, outline) per document, the outline at a set's first
    document in the task, and (1, n-gram, count, 0, null) per common n-gram."""

    def report(kept: list[np.ndarray]) -> pa.RecordBatch:
        grams, count = np.unique(np.concatenate(kept), return_counts=True)
        often = count >= COUNT_LEAST
        grams, count = signed(grams[often]), count[often]
        one = np.ones(len(grams), np.int32)
        return batch(SET_ROWS, one, grams, count, np.zeros(len(grams), np.int64), [None] * len(grams))

    def run(batches):
        kept, size, seen = [], 0, set()
        for rows in chunks(batches, 1 << 21, "text"):
            found = Shingles(rows.column("text"), words)
            outlines: list[bytes | None] = []
            for i, sig in enumerate(found.signature.tolist()):
                new = found.sizes[i] > 0 and sig not in seen
                seen.add(sig)
                outlines.append(outline(found.row(i)) if new else None)
            kept.append(found.grams)
            size += len(found.grams)
            zero = np.zeros(rows.num_rows, np.int32)
            yield batch(SET_ROWS, zero, rows.column("id"), found.sizes, found.signature, outlines)
            if size >= COUNT_BLOCK:
                yield report(kept)
                kept, size = [], 0
        if kept:
            yield report(kept)

    return run


def _entries(rule: Rule, common):
    """Prefix entries of each distinct set."""

    def run(batches):
        grams_common, count_common = common.value
        seen: set[int] = set()
        for rows in chunks(batches, 1 << 21, "text"):
            found = Shingles(rows.column("text"), rule.words)
            order = np.zeros(len(found.grams), np.int64)
            if len(grams_common):
                at = np.minimum(np.searchsorted(grams_common, found.grams), len(grams_common) - 1)
                order = np.where(grams_common[at] == found.grams, count_common[at], 0)
            out: list[np.ndarray] = []
            nodes, sizes = [], []
            for i, node in enumerate(found.signature.tolist()):
                if not found.sizes[i] or node in seen:
                    continue
                seen.add(node)
                grams, late = found.row(i), order[found.ends[i] : found.ends[i + 1]]
                if late.any():
                    grams = grams[np.argsort(late, kind="stable")]
                out.append(grams[: rule.prefix(len(grams))])
                nodes.append(node)
                sizes.append(len(grams))
            if out:
                lengths = np.array([len(g) for g in out])
                yield batch(
                    ENTRY_ROWS,
                    signed(np.concatenate(out)),
                    np.repeat(np.array(nodes, np.int64), lengths),
                    np.repeat(np.array(sizes, np.int32), lengths),
                    np.concatenate([np.arange(k, dtype=np.int32) for k in lengths]),
                )

    return run


def size_class(n: Column, rule: Rule) -> Column:
    """Sizes within a factor of the threshold; sets that link are in one class or in two neighbours."""
    return F.floor(F.log(n.cast("double")) / F.lit(-float(np.log(rule.num / rule.den)) or 1.0)).cast("int")


def _lists(rule: Rule):
    """Entries in ``LIST_ORDER``: those of n-grams that two nodes share (kind 0), and pairs
    (kind 1) of each entry with the one before it and with the leader of its size class, and of leaders of
    neighbouring classes. A leader has the fewest rarer n-grams: of copies, the one with the fewest
    changes, which most others link with."""

    def emit(kind, s, x, n, y, m, pos):
        return batch(LIST_ROWS, np.full(len(s), kind, np.int32), s, x, n, y, m, pos)

    def run(batches):
        held = None  # last entry of the batch before, whether it is shared, its leader and the one before
        for rows in batches:
            if not rows.num_rows:
                continue
            cols = [rows.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in LIST_ORDER]
            if held is not None:
                cols = [np.concatenate([[h], c]) for h, c in zip(held[0], cols)]
            s, size_, pos, n, node = cols
            same = np.ones(len(s), bool)  # copies of an entry that other tasks found
            same[1:] = (s[1:] != s[:-1]) | (node[1:] != node[:-1])
            s, size_, pos, n, node = (c[same] for c in cols)
            joined = np.zeros(len(s), bool)
            joined[1:] = s[1:] == s[:-1]
            starts = ~joined
            starts[1:] |= size_[1:] != size_[:-1]
            at = np.arange(len(s))
            first = np.maximum.accumulate(np.where(starts, at, 0))
            lead, lead_n = node[first], n[first]
            if held is not None:  # the first class goes on from the batch before
                lead, lead_n = np.where(first == 0, held[2][0], lead), np.where(first == 0, held[2][1], lead_n)
            shared = joined.copy()
            shared[:-1] |= joined[1:]
            if held is not None:
                shared[0] |= held[1]
            keep = shared.copy()
            keep[-1] = False  # the last entry goes out with the next batch
            yield emit(0, s[keep], node[keep], n[keep], node[keep], n[keep], pos[keep])
            after = np.flatnonzero(joined)
            led = after[(lead[after] != node[after]) & (lead[after] != node[after - 1])]
            heads = np.flatnonzero(starts & joined)
            left = [(node[after - 1], n[after - 1]), (lead[led], lead_n[led]), (lead[heads - 1], lead_n[heads - 1])]
            right = [(node[after], n[after]), (node[led], n[led]), (node[heads], n[heads])]
            a, a_n = (np.concatenate(c) for c in zip(*left))
            b, b_n = (np.concatenate(c) for c in zip(*right))
            ok = (np.minimum(a_n, b_n) * rule.den >= np.maximum(a_n, b_n) * rule.num) & (a != b)
            swap = a > b
            x, y = np.where(swap, b, a)[ok], np.where(swap, a, b)[ok]
            x_n, y_n = np.where(swap, b_n, a_n)[ok], np.where(swap, a_n, b_n)[ok]
            zero = np.zeros(len(x), np.int64)
            yield emit(1, zero, x, x_n, y, y_n, zero)
            held = ([c[-1] for c in (s, size_, pos, n, node)], bool(shared[-1]), (lead[-1], lead_n[-1]))
        if held is not None and held[1]:
            s, _, pos, n, node = (np.array([v]) for v in held[0])
            yield emit(0, s, node, n, node, n, pos)

    return run


def _needed_sets(words: int, bits):
    """Whole sets of the representatives that pass the filter."""

    def run(batches):
        flags = bits.value
        for rows in chunks(batches, 1 << 21, "text"):
            found = Shingles(rows.column("text"), words)
            ids = rows.column("id").fill_null(0).to_numpy(zero_copy_only=False)
            slot = slot_of(found.signature, ids)
            passed = (flags[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1)
            wanted = np.flatnonzero((passed == 1) & (found.sizes > 0))
            yield batch(NODE_SETS, found.signature[wanted], [found.row(i).tobytes() for i in wanted])

    return run


def _possible(rule: Rule):
    """Pairs whose outlines do not rule the link out."""

    def run(batches):
        for rows in batches:
            n, m = (rows.column(c).to_numpy() for c in ("n", "m"))
            a, b = rows.column("a"), rows.column("b")
            ok = np.array(
                [
                    most_shared(a[i].as_buffer(), int(n[i]), b[i].as_buffer(), int(m[i])) * (rule.num + rule.den)
                    >= int(n[i] + m[i]) * rule.num
                    for i in range(rows.num_rows)
                ],
                bool,
            )
            kept = rows.filter(pa.array(ok))
            slots = [slot_of(kept.column(c).to_numpy(), kept.column(f"{c}_id").to_numpy()) for c in ("x", "y")]
            yield batch(PAIR_ROWS, kept.column("x"), kept.column("y"), *slots)

    return run


def _added(parts: list[np.ndarray]) -> np.ndarray:
    """Columns x, y, n, m, c, px, py: one per pair, counts added, places the last ones."""
    x, y, n, m, c, px, py = np.concatenate(parts, axis=1)
    order = np.lexsort((y, x))
    x, y, n, m, c, px, py = (a[order] for a in (x, y, n, m, c, px, py))
    new = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]))
    added, last_x, last_y = np.add.reduceat(c, new), np.maximum.reduceat(px, new), np.maximum.reduceat(py, new)
    return np.stack([x[new], y[new], n[new], m[new], added, last_x, last_y])


def _product(rule: Rule):
    """Entries (main, s, node, n, pos, root, earlier), lists one after the other, to pairs of
    different classes that can link: the smaller classes of a list against all of it."""
    names = ("s", "main", "node", "n", "pos", "root", "earlier")

    def able(rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Product columns of the entry pairs (i, j) whose documents can link."""
        _, _, node, n, pos, root, earlier = rows
        need = -(-rule.num * (n[i] + n[j]) // (rule.num + rule.den))  # overlap that these sizes ask for
        ok = root[i] != root[j]
        ok &= np.minimum(n[i], n[j]) * rule.den >= np.maximum(n[i], n[j]) * rule.num
        ok &= (pos[i] <= n[i] - need) & (pos[j] <= n[j] - need)
        ok &= np.minimum(earlier[i], earlier[j]) + np.minimum((n - pos)[i], (n - pos)[j]) >= need
        i, j = i[ok], j[ok]
        swap = node[i] > node[j]
        x, y = np.where(swap, j, i), np.where(swap, i, j)
        return np.stack([node[x], node[y], n[x], n[y], np.ones(len(x), np.int64), pos[x], pos[y]])

    def of_list(rows: np.ndarray) -> Iterator[np.ndarray]:
        _, main, node, _, _, root, _ = rows
        few = np.flatnonzero(root != main)
        step = max(1, PRODUCTS // len(node))
        for at in range(0, len(few), step):
            i = np.repeat(few[at : at + step], len(node))
            j = np.tile(np.arange(len(node)), len(i) // len(node))
            once = (root[j] == main[0]) | (node[i] < node[j])
            yield able(rows, i[once], j[once])

    def of_lists(rows: np.ndarray) -> Iterator[np.ndarray]:
        edges = np.flatnonzero(np.concatenate([[True], rows[0, 1:] != rows[0, :-1], [True]]))
        sizes = np.diff(edges)
        pairs = edges[:-1][sizes == 2]  # most lists
        yield able(rows, pairs, pairs + 1)
        for a, size in zip(edges[:-1][sizes > 2], sizes[sizes > 2]):
            yield from of_list(rows[:, a : a + size])

    def run(batches):
        held: list[np.ndarray] = []
        kept: list[np.ndarray] = []
        size = 0

        def lists(rows: np.ndarray):
            nonlocal kept, size
            for part in of_lists(rows):
                if part.shape[1]:
                    kept.append(part)
                    size += part.shape[1]
                if size >= PRODUCTS:
                    yield batch(PRODUCT_ROWS, *_added(kept))
                    kept, size = [], 0

        for rows in batches:
            if not rows.num_rows:
                continue
            columns = [rows.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names]
            held.append(np.stack(columns))
            if held[0][0, 0] == columns[0][-1]:
                continue  # still the first list
            whole = np.concatenate(held, axis=1)
            last = len(whole[0]) - int((whole[0, ::-1] != whole[0, -1]).argmax())
            yield from lists(whole[:, :last])
            held = [whole[:, last:]]
        if held:
            yield from lists(np.concatenate(held, axis=1))
        if kept:
            yield batch(PRODUCT_ROWS, *_added(kept))

    return run


def _checked(rule: Rule):
    """Pairs whose whole sets link."""

    def run(batches):
        for rows in batches:
            xs, ys = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("x", "y"))
            a, b = rows.column("a"), rows.column("b")
            ok = np.zeros(len(xs), bool)
            for i in range(len(xs)):
                left = np.frombuffer(a[i].as_buffer(), np.uint64)
                right = np.frombuffer(b[i].as_buffer(), np.uint64)
                if len(left) > len(right):
                    left, right = right, left
                at = np.minimum(np.searchsorted(right, left), len(right) - 1)
                both = int((right[at] == left).sum())
                ok[i] = rule.den * both >= rule.num * (len(left) + len(right) - both)
            yield batch(LINK_ROWS, xs[ok], ys[ok])

    return run


def _links(texts: DataFrame, nodes: DataFrame, pairs: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (x, n, y, m) that link. Outlines rule most of the others out; what is left is
    checked on whole sets, and only sets of such pairs are moved."""
    spark = texts.sparkSession

    def of(c: str, value: str, name: str):
        return nodes.select(F.col("sig").alias(c), F.coalesce("id", F.lit(0)).alias(f"{c}_id"), F.col(value).alias(name))

    outlined = pairs.join(of("x", "bits", "a"), "x").join(of("y", "bits", "b"), "y")
    outlined = outlined.select("x", "y", "n", "m", "a", "b", "x_id", "y_id")
    pairs = stored(outlined.mapInArrow(_possible(rule), _ddl(PAIR_ROWS)), "possible")
    words = (
        pairs.select(F.explode(F.array("x_slot", "y_slot")).alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))
        .collect()  # at most 2**FILTER_BITS / 64 rows
    )
    flags = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    for row in words:
        flags[row.word] = np.int64(row.bits).view(np.uint64)
    bits = spark.sparkContext.broadcast(flags)
    sets = stored(texts.mapInArrow(_needed_sets(rule.words, bits), _ddl(NODE_SETS)), "sets")
    joined = (
        pairs.select("x", "y")
        .join(sets.select(F.col("node").alias("x"), F.col("grams").alias("a")), "x")
        .join(sets.select(F.col("node").alias("y"), F.col("grams").alias("b")), "y")
    )
    return stored(joined.mapInArrow(_checked(rule), _ddl(LINK_ROWS)), "links")


def _blocks(entries: DataFrame, rule: Rule) -> DataFrame:
    """Products of lists, those of one main class together, so that a pair's products meet in
    one task. A class with very many entries is spread over several blocks."""
    large = entries.groupBy("main").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > BLOCK_ENTRIES)
    spread = F.pmod(F.xxhash64("s"), F.ceil(F.col("rows") / BLOCK_ENTRIES))
    dealt = entries.join(stored(large, "large"), "main", "left")
    dealt = dealt.withColumn("block", F.coalesce(spread, F.lit(0)))
    ordered = dealt.repartition("main", "block").sortWithinPartitions("s", "node")
    return ordered.mapInArrow(_product(rule), _ddl(PRODUCT_ROWS))


def _joined(entries: DataFrame, rule: Rule) -> DataFrame:
    """The same products for lists too long for a block, by a join that AQE can split."""
    columns = ("s", "node", "n", "pos", "root", "earlier")
    left = entries.where("root <> main").select(*(F.col(c).alias(f"l_{c}") for c in columns))
    right = entries.select(*(F.col(c).alias(f"r_{c}") for c in (*columns, "main")))
    total = F.col("l_n").cast("long") + F.col("r_n")
    need = F.ceil(total * rule.num / (rule.num + rule.den) - 1e-9)
    reach = F.least("l_earlier", "r_earlier") + F.least(F.expr("l_n - l_pos"), F.expr("r_n - r_pos"))
    met = left.join(right, F.col("l_s") == F.col("r_s")).where(
        (F.col("l_root") != F.col("r_root"))
        # two small classes meet twice: count them once
        & ((F.col("r_root") == F.col("r_main")) | (F.col("l_node") < F.col("r_node")))
        & (F.least("l_n", "r_n").cast("long") * rule.den >= F.greatest("l_n", "r_n").cast("long") * rule.num)
        & (F.col("l_pos") <= F.col("l_n") - need)
        & (F.col("r_pos") <= F.col("r_n") - need)
        & (reach >= need)
    )
    swap = F.col("l_node") > F.col("r_node")

    def ordered(column: str, first: str, second: str) -> list[Column]:
        a, b = F.col(f"l_{column}").cast("long"), F.col(f"r_{column}").cast("long")
        return [F.when(swap, b).otherwise(a).alias(first), F.when(swap, a).otherwise(b).alias(second)]

    one = F.lit(1).cast("long").alias("c")
    met = met.select(*ordered("node", "x", "y"), *ordered("n", "n", "m"), one, *ordered("pos", "px", "py"))
    return met.groupBy("x", "y", "n", "m").agg(F.sum("c").alias("c"), F.max("px").alias("px"), F.max("py").alias("py"))


def shingle_classes(
    docs: DataFrame,
    words: int = 4,
    threshold: str = "0.85",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: (id, n_shingles, component_id).

    ``n_shingles`` is the size of the set of distinct ``words``-word n-grams; a text with
    fewer words has one n-gram, all its words; null, empty and blank texts have none and
    link with nothing. Rows link when the Jaccard similarity of their sets is at least
    ``threshold`` (a decimal text, compared exactly); ``component_id`` is the smallest id
    reachable. Repeated rows stay and link with each other. A null id takes part: its
    class has the smallest id that is not null, or null if there is none. Other columns are
    ignored, whatever their names. N-grams are told apart by 64-bit hashes.
    """
    share = Fraction(threshold)
    rule = Rule(words, share.numerator, share.denominator)
    spark = prepare(docs.sparkSession)
    texts = _texts(docs, id_col, text_col)
    described = stored(texts.mapInArrow(_describe(words), _ddl(SET_ROWS)), "described")
    sets = described.where("kind = 0").select("id", "n", "sig", "bits")
    often = stored(described.where("kind = 1").groupBy("id").agg(F.sum("n").alias("n")), "often")
    top = most_frequent(often, "n", COMMON_ROWS)
    grams = np.array([r.id for r in top], np.int64).view(np.uint64)
    by_gram = np.argsort(grams)
    rank = np.array([r.n for r in top], np.int64)
    common = spark.sparkContext.broadcast((grams[by_gram], rank[by_gram]))

    entries = texts.select("text").mapInArrow(_entries(rule, common), _ddl(ENTRY_ROWS))
    ordered = entries.repartition("s").withColumn("class", size_class(F.col("n"), rule))
    lists = stored(
        ordered.sortWithinPartitions(*LIST_ORDER).mapInArrow(_lists(rule), _ddl(LIST_ROWS)), "lists"
    )
    nodes = stored(
        sets.where("n > 0").groupBy("sig").agg(F.min("id").alias("id"), F.any_value("bits", True).alias("bits")),
        "nodes",
    )
    # Pairs that stand side by side in a quarter of the shorter prefix are most likely links.
    likely_from = F.least("n", "m") * F.lit((rule.den - rule.num) / rule.den / 4)
    likely = stored(
        lists.where("kind = 1")
        .groupBy("x", "y", "n", "m")
        .agg(F.count(F.lit(1)).alias("c"))
        .where(F.col("c") >= likely_from)
        .select("x", "n", "y", "m"),
        "likely",
    )
    found = _links(texts, nodes, likely, rule)
    class_of = stored(components(found), "classes")

    entries = lists.where("kind = 0").select("s", F.col("x").alias("node"), "n", "pos")
    labelled = entries.withColumn("k", F.xxhash64("node")).join(
        class_of.withColumn("k", F.xxhash64("node")), ["node", "k"], "left"
    )
    labelled = stored(
        labelled.select("s", "node", "n", "pos", F.coalesce("root", "node").alias("root")), "labelled"
    )
    # The class that has most of a list; the list matters only if there is another class.
    sizes = labelled.groupBy("s", "root").agg(F.count(F.lit(1)).alias("c"))
    mixed = (
        sizes.groupBy("s")
        .agg(
            F.count(F.lit(1)).alias("classes"),
            F.sum("c").alias("entries"),
            F.max_by("root", F.struct("c", "root")).alias("main"),
        )
        .where("classes > 1")
        .select("s", "main", "entries")
    )
    mixed = stored(mixed, "mixed").withColumn("k", F.xxhash64("s"))
    # Entries of a node before this one that other classes have too. The others before it are not in
    # any set of another class that has this n-gram: its prefix would hold them.
    earlier = F.row_number().over(Window.partitionBy("node").orderBy("pos")) - 1
    open_lists = stored(
        labelled.withColumn("k", F.xxhash64("s")).join(mixed, ["s", "k"]).drop("k").withColumn("earlier", earlier),
        "open-lists",
    )
    products = _blocks(open_lists.where(F.col("entries") <= BLOCK_ENTRIES), rule).unionByName(
        _joined(open_lists.where(F.col("entries") > BLOCK_ENTRIES), rule)
    )
    still = F.col("c") + F.least(F.col("n") - 1 - F.col("px"), F.col("m") - 1 - F.col("py"))
    pairs = stored(
        products.groupBy("x", "y", "n", "m")
        .agg(F.sum("c").alias("c"), F.max("px").alias("px"), F.max("py").alias("py"))
        .where(still * (rule.num + rule.den) >= (F.col("n") + F.col("m")) * rule.num)
        .select("x", "n", "y", "m"),
        "pairs",
    )
    more = _links(texts, nodes, pairs, rule)
    links = class_of.select(F.col("node").alias("x"), F.col("root").alias("y")).unionByName(more)
    classes = stored(components(links), "classes")

    rooted = nodes.select("sig", "id").join(classes.withColumnRenamed("node", "sig"), "sig", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "sig"))
    by_root = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    member = stored(rooted.select("sig", "root").join(by_root, "root").select("sig", "component_id"), "member")
    out = sets.withColumn("sig", F.when(F.col("n") > 0, F.col("sig"))).join(member, "sig", "left")
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )


def keep_first(
    docs: DataFrame,
    words: int = 5,
    threshold: str = "0.8",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` without near-copies: exactly one row of each class stays.

    It is the row with the smallest id, a null id coming last; of rows that share it, the first one.
    Rows are told apart by a number of their own, so repeated and null ids hide no copy. All
    columns stay. Rows without words (null, empty and blank texts) are no one's copies and stay.
    """
    row = "_row"
    while row in docs.columns:
        row = f"_{row}"
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    classes = stored(shingle_classes(numbered, words, threshold, row, text_col), "classes")
    ids = numbered.select(F.col(row).alias("r"), F.col(id_col).cast("bigint").alias("i"))
    members = classes.where("n_shingles > 0").select(F.col(row).alias("r"), F.col("component_id").alias("c"))
    members = stored(members.join(ids, "r"), "members")
    # one row per class, reduced before it moves: a class may hold a third of all rows
    first = members.groupBy("c").agg(F.min(F.struct(F.col("i").isNull().alias("n"), "i", "r"))["r"].alias("r"))
    gone = stored(members.select("r").join(first.select("r"), "r", "left_anti"), "gone")
    few = gone.count() <= BROADCAST_IDS  # of a stored table; up to the bound a broadcast saves moving all texts
    gone = gone.withColumnRenamed("r", row)
    return numbered.join(F.broadcast(gone) if few else gone, row, "left_anti").select(*docs.columns)
