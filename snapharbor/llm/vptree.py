"""Nearest neighbours by inner product with a vantage-point tree per shard.

Vectors are dealt to shards of a bounded size; each shard's tree is built once and stored.
To make the largest inner product the smallest distance, every vector gets one more coordinate
that brings it to the length of the longest one; a query gets 0 there. A subtree is
skipped if the triangle inequality puts all of it beyond the k-th best so far. The
bound may be multiplied by a relaxation factor: at 1 the search is exact, above 1 it skips more and may
miss some. Blocks of queries meet every shard; the best of the shards are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapharbor.llm.shared import batch, prepare, stored

NEIGHBOURS = 20
SHARD_ROWS = 8192
QUERY_BLOCK = 1024
LEAF = 128

ROWS = pa.schema([("dim", pa.int32()), ("part", pa.int64()), ("body", pa.binary())])
ROWS_DDL = "dim int, part bigint, body binary"
FOUND = pa.schema(
    [("query_row", pa.int64()), ("query_id", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]
)
FOUND_DDL = "query_row bigint, query_id bigint, `row` bigint, vec_id bigint, score double"


def _pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays of 8-byte items behind their lengths."""
    sizes = np.array([len(arrays), *(a.size for a in arrays)], np.int64)
    return b"".join([sizes.tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)])


def _unpack(body, kinds: str) -> list[np.ndarray]:
    whole = np.frombuffer(body, np.int64)
    sizes, at, out = whole[1 : 1 + whole[0]], 1 + int(whole[0]), []
    for size, kind in zip(sizes.tolist(), kinds):
        part = whole[at : at + size]
        out.append(part.view(np.float64) if kind == "f" else part)
        at += size
    return out


class Tree:
    """Vantage-point tree. Rows are stored in leaf order; node i is described by
    (first row, end row, vantage vector, inner child, outer child), a leaf having child -1,
    and by the least and largest distance from its vantage vector in either child."""

    def __init__(self, vectors: np.ndarray, row: np.ndarray, vec_id: np.ndarray, longest2: float):
        self.extra = np.sqrt(np.maximum(longest2 - (vectors * vectors).sum(1), 0.0))
        self.vectors, self.row, self.vec_id = vectors, row, vec_id
        self.nodes: list[list[int]] = []
        self.reach: list[list[float]] = []
        order = np.arange(len(vectors))
        self._build(order, 0, len(vectors))
        # the children have moved the rows on: look the vantage rows up in the final order
        position = np.empty(len(order), np.int64)
        position[order] = np.arange(len(order))
        self.vantage = np.array([position[n[2]] if n[2] >= 0 else -1 for n in self.nodes], np.int64)
        self.vectors, self.extra = vectors[order], self.extra[order]
        self.row, self.vec_id = row[order], vec_id[order]

    def _distance(self, at: np.ndarray, vantage: int) -> np.ndarray:
        gap = self.vectors[at] - self.vectors[vantage]
        return np.sqrt((gap * gap).sum(1) + (self.extra[at] - self.extra[vantage]) ** 2)

    def _build(self, order: np.ndarray, a: int, b: int) -> int:
        me = len(self.nodes)
        self.nodes.append([a, b, -1, -1, -1])
        self.reach.append([0.0, 0.0, 0.0, 0.0])
        if b - a <= LEAF:
            return me
        # the row farthest from an arbitrary one stands at the edge of the cloud
        vantage = order[a + int(self._distance(order[a:b], order[a]).argmax())]
        far = self._distance(order[a:b], vantage)
        if far.max() <= 0.0:  # all the same vector
            return me
        by_far = np.argsort(far, kind="stable")
        order[a:b], far = order[a:b][by_far], far[by_far]
        half = (b - a) // 2
        self.reach[me] = [far[0], far[half - 1], far[half], far[-1]]
        inner = self._build(order, a, a + half)
        outer = self._build(order, a + half, b)
        self.nodes[me] = [a, b, int(vantage), inner, outer]
        return me

    def body(self) -> bytes:
        return _pack(
            [self.vectors, self.extra, self.row, self.vec_id]
            + [np.array(self.nodes, np.int64).reshape(-1, 5), self.vantage, np.array(self.reach).reshape(-1, 4)]
        )

    @classmethod
    def of_body(cls, body, dim: int) -> Tree:
        tree = cls.__new__(cls)
        vectors, tree.extra, tree.row, tree.vec_id, nodes, tree.vantage, reach = _unpack(body, "ffiiiif")
        tree.vectors, tree.nodes, tree.reach = vectors.reshape(-1, dim), nodes.reshape(-1, 5), reach.reshape(-1, 4)
        return tree


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision and in the order of the coordinates."""
    total = np.zeros(len(a))
    for k in range(a.shape[1]):
        total += a[:, k] * b[:, k]
    return total


class Search:
    """The k best of one tree for a block of queries, best first, ties to the smaller id, then row."""

    def __init__(self, tree: Tree, queries: np.ndarray, query_row: np.ndarray, longest2: float, k: int, factor: float):
        self.tree, self.queries, self.query_row, self.k, self.factor = tree, queries, query_row, k, factor
        self.span = (queries * queries).sum(1) + longest2
        self.slack = 1e-9 * (self.span + 1.0)  # rounding of the quick products
        self.score = np.full((len(queries), k), -np.inf)
        self.at = np.full((len(queries), k), -1, np.int64)
        if len(tree.nodes):
            self._visit(0, np.arange(len(queries)))

    def _radius(self, q: np.ndarray) -> np.ndarray:
        """Distance of the k-th best so far."""
        worst = self.score[q, -1]
        return np.sqrt(np.maximum(self.span[q] - 2.0 * worst, 0.0) + self.slack[q])

    def _visit(self, node: int, q: np.ndarray) -> None:
        a, b, _, inner, outer = self.tree.nodes[node].tolist()
        if inner < 0:
            self._leaf(a, b, q)
            return
        vantage = int(self.tree.vantage[node])
        product = self.queries[q] @ self.tree.vectors[vantage]
        d = np.sqrt(np.maximum(self.span[q] - 2.0 * product, 0.0))
        reach = self.tree.reach[node]
        bound = {
            inner: np.maximum(reach[0] - d, d - reach[1]),
            outer: np.maximum(reach[2] - d, d - reach[3]),
        }
        near_inner = bound[inner] <= bound[outer]
        for first, second, mine in ((inner, outer, near_inner), (outer, inner, ~near_inner)):
            for child in (first, second):
                on = mine & (np.maximum(bound[child], 0.0) * self.factor <= self._radius(q) * (1 + 1e-12))
                if on.any():
                    self._visit(child, q[on])

    def _leaf(self, a: int, b: int, q: np.ndarray) -> None:
        tree, k = self.tree, self.k
        quick = self.queries[q] @ tree.vectors[a:b].T
        quick[self.query_row[q][:, None] == tree.row[a:b][None, :]] = -np.inf
        hit_q, hit_r = np.nonzero(quick >= self.score[q, -1][:, None] - self.slack[q][:, None])
        hit_q, hit_r = hit_q[quick[hit_q, hit_r] > -np.inf], hit_r[quick[hit_q, hit_r] > -np.inf]
        exact = inner_products(self.queries[q[hit_q]], tree.vectors[a + hit_r])
        edges = np.searchsorted(hit_q, np.arange(len(q) + 1))
        for i in np.flatnonzero(np.diff(edges)):
            me, part = q[i], slice(edges[i], edges[i + 1])
            score = np.concatenate([self.score[me], exact[part]])
            at = np.concatenate([self.at[me], a + hit_r[part]])
            best = np.lexsort((tree.row[at], tree.vec_id[at], -score))[:k]
            self.score[me], self.at[me] = score[best], at[best]


def _trees(k: int, longest2: dict[int, float]):
    """Rows (dim, part, row, vec_id, v) of one shard to its tree."""

    def run(rows: pa.Table) -> pa.Table:
        dim = rows.column("dim")[0].as_py()
        vectors = rows.column("v").combine_chunks().values.to_numpy(zero_copy_only=False).reshape(-1, dim)
        row, vec_id = rows.column("row").to_numpy(), rows.column("vec_id").to_numpy()
        # Of equal vectors, no search can return more than the k + 1 with the smallest ids.
        order = np.lexsort((row, vec_id, *vectors.T))
        vectors, row, vec_id = vectors[order], row[order], vec_id[order]
        new = np.ones(len(row), bool)
        new[1:] = (vectors[1:] != vectors[:-1]).any(1)
        start = np.maximum.accumulate(np.where(new, np.arange(len(row)), 0))
        keep = np.arange(len(row)) - start <= k
        tree = Tree(vectors[keep], row[keep], vec_id[keep], longest2[dim])
        return pa.Table.from_batches([batch(ROWS, [dim], [rows.column("part")[0].as_py()], [tree.body()])])

    return run


def _blocks(rows: pa.Table) -> pa.Table:
    """Query rows of one block to one row."""
    dim = rows.column("dim")[0].as_py()
    body = _pack(
        [
            rows.column("row").to_numpy(),
            rows.column("vec_id").to_numpy(),
            rows.column("v").combine_chunks().values.to_numpy(zero_copy_only=False),
        ]
    )
    return pa.Table.from_batches([batch(ROWS, [dim], [rows.column("block")[0].as_py()], [body])])


def _search(k: int, factor: float, longest2: dict[int, float]):
    def run(batches: Iterator[pa.RecordBatch]):
        for rows in batches:
            for i in range(rows.num_rows):
                dim = rows.column("dim")[i].as_py()
                tree = Tree.of_body(rows.column("body")[i].as_buffer(), dim)
                row, vec_id, queries = _unpack(rows.column("queries")[i].as_buffer(), "iif")
                found = Search(tree, queries.reshape(-1, dim), row, longest2[dim], k, factor)
                q, j = np.nonzero(found.at >= 0)
                at = found.at[q, j]
                yield batch(FOUND, row[q], vec_id[q], tree.row[at], tree.vec_id[at], found.score[q, j])

    return run


def valid_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(row, vec_id, dim, v): vectors with an id that are finite and not zero, numbered."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")
    )
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0.0))
    return rows.select(
        F.monotonically_increasing_id().alias("row"), "vec_id", F.size("v").cast("int").alias("dim"), "v"
    )


def nearest(
    vectors: DataFrame,
    query_modulus: int = 20,
    neighbours: int = NEIGHBOURS,
    factor: float = 1.0,
    shard_rows: int = SHARD_ROWS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``query_modulus`` the
    ``neighbours`` rows with the largest inner product, best first, ties to the smaller id.

    Null vectors, zero ones and those with a null or non-finite component take no part, nor
    do rows without an id. Vectors are compared with those of their own length. A row is never its own
    neighbour; another row with the same id may be, and a repeated query id is answered
    once per row. Queries without candidates give no row. Other columns are ignored.
    ``factor`` 1 is exact; above it, subtrees are skipped earlier.
    """
    spark = prepare(vectors.sparkSession)
    rows = stored(valid_vectors(vectors, id_col, vector_col), "vectors")
    is_query = F.col("vec_id") % query_modulus == 0
    norm2 = F.aggregate("v", F.lit(0.0), lambda t, x: t + x * x)
    # one row per vector length
    sizes = rows.groupBy("dim").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(is_query.cast("long")).alias("queries"), F.max(norm2).alias("longest2")
    )
    sizes = sizes.collect()
    longest2 = {r["dim"]: r["longest2"] for r in sizes}
    parts = {r["dim"]: -(-r["rows"] // shard_rows) for r in sizes}
    blocks = {r["dim"]: max(1, -(-r["queries"] // QUERY_BLOCK)) for r in sizes}
    if not sizes:
        parts = blocks = {0: 1}

    def per_dim(values: dict[int, int]):
        return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))[F.col("dim")]

    dealt = rows.withColumn("part", F.pmod(F.xxhash64("row"), per_dim(parts)).cast("bigint"))
    trees = stored(
        dealt.groupBy("dim", "part").applyInArrow(_trees(neighbours, longest2), ROWS_DDL), "trees"
    )
    asked = rows.where(is_query).withColumn("block", F.pmod(F.xxhash64(F.lit(1), "row"), per_dim(blocks)).cast("bigint"))
    asked = asked.groupBy("dim", "block").applyInArrow(_blocks, ROWS_DDL)
    asked = stored(asked.select("dim", F.col("part").alias("block"), F.col("body").alias("queries")), "queries")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), per_dim(parts) - 1)).alias("part")
    met = trees.join(asked.select("dim", "block", "queries", every), ["dim", "part"])
    met = met.select("dim", "part", "block", "body", "queries").repartition("part", "block")
    found = met.mapInArrow(_search(neighbours, factor, longest2), FOUND_DDL)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= neighbours)
        .select("query_id", "rank", "vec_id", "score")
    )
