"""Shards by a weighted hash tree: region, rack, shard.

At each level a key draws a number for every child, -ln(u) / weight with u from a hash of key and
child, and goes to the smallest. A child's weight is the total of its shards. When weights change,
keys only move into subtrees that grew or out of those that shrank; all other subtrees keep
what they have. Everything is a DataFrame expression; rows are only moved to number them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapharbor.llm.shared import prepare, stored

SHARDS_PER_RACK = 2
RACKS_PER_REGION = 2
_LOW = (1 << 33) - 1  # monotonically_increasing_id: partition above, row below

Tree = Mapping[str, Mapping[str, Mapping[int, float]]]


def layout(shards: int, weights: Mapping[int, float] | None = None) -> Tree:
    """Shards 0 to ``shards`` - 1, two to a rack and two racks to a region, filled in order.

    So shard 8 opens a region of its own: rows then move into it from all others, and no row
    moves between the others. A shard that joins an older region also draws rows into
    that region's other racks.
    """
    tree: dict = {}
    for s in range(shards):
        rack = s // SHARDS_PER_RACK
        region = rack // RACKS_PER_REGION
        racks = tree.setdefault(f"region-{region}", {})
        racks.setdefault(f"rack-{rack}", {})[s] = float((weights or {}).get(s, 1.0))
    return tree


def uniform(key: Column, node: Column) -> Column:
    """A number above 0 and below 1 from key and node."""
    digits = F.conv(F.substring(F.md5(F.concat(key, F.lit("/"), node)), 1, 12), 16, 10)
    return (digits.cast("double") + 0.5) / F.lit(float(1 << 48))


def place(key: Column, tree: Tree) -> Column:
    """The shard of a key. The tree travels as literal maps, an entry per node; shards of weight 0
    get nothing."""
    by_node: dict[str, list[tuple[str, float]]] = {"": []}
    for region, racks in tree.items():
        for rack, shards in racks.items():
            by_node[rack] = [(str(s), w) for s, w in shards.items() if w > 0]
            by_node.setdefault(region, []).append((rack, sum(shards.values())))
        by_node[""].append((region, sum(w for _, w in by_node[region])))

    def children(node: Column) -> Column:
        entries = []
        for name, below in by_node.items():
            pairs = [F.struct(F.lit(c).alias("child"), F.lit(float(w)).alias("weight")) for c, w in below if w > 0]
            if pairs:
                entries += [F.lit(name), F.array(*pairs)]
        return F.element_at(F.create_map(*entries), node)

    node = F.lit("")
    for _ in range(3):
        drawn = F.transform(
            children(node), lambda c: F.struct((-F.ln(uniform(key, c["child"])) / c["weight"]).alias("d"), c["child"].alias("child"))
        )
        node = F.array_min(drawn)["child"]
    return node.cast("int")


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``slot``: 0, 1, ... within each value of ``group``, by ``order``.

    Rows are range-sorted by (group, order); a running number orders what is still equal, so that
    repeated rows can be split too. A partition's first slot in a group is the number of rows that
    the group has in earlier partitions: a table with a row per partition and group.
    """
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    ranged = rows.repartitionByRange(group, *order, "_row").sortWithinPartitions(group, *order, "_row")
    ranged = stored(ranged.withColumn("_place", F.monotonically_increasing_id()), "ranged")
    part = F.shiftright("_place", 33)
    parts = ranged.groupBy(part.alias("_part"), group).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.col("_place").bitwiseAND(_LOW)).alias("low")
    )
    # as many rows as partitions, and one more for each border between groups
    found = sorted((r["_part"], r[group], r["n"], r["low"]) for r in parts.collect())
    before: dict[int, int] = {}
    offsets = []
    for p, g, n, low in found:
        offsets.append((p, g, before.get(g, 0) - low))
        before[g] = before.get(g, 0) + n
    spark = rows.sparkSession
    kind = dict(rows.dtypes)[group]
    table = spark.createDataFrame(offsets, f"_part bigint, _group {kind}, _offset bigint")
    joined = ranged.join(F.broadcast(table), (part == F.col("_part")) & (F.col(group) == F.col("_group")))
    slot = F.col("_place").bitwiseAND(_LOW) + F.col("_offset")
    return joined.withColumn("slot", slot).drop("_row", "_place", "_part", "_group", "_offset")


def sharded(
    docs: DataFrame, tree: Tree, grown: Tree, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: (doc_id, size, text_crc32, law, shard, slot, grown_shard).

    ``size`` is the text's UTF-8 bytes plus 1, ``text_crc32`` the checksum of those bytes, a null text
    having none. The id alone decides the shard, so rows of one id, repeated ones and all rows
    without an id share theirs; a null id stays null. ``slot`` numbers a shard's rows by id,
    checksum and size. ``grown_shard`` is the shard in the tree ``grown``. Other columns are ignored.
    """
    prepare(docs.sparkSession)
    doc_id, text = F.col(id_col).cast("bigint"), F.col(text_col).cast("string")
    key = F.coalesce(doc_id.cast("string"), F.lit("null"))
    rows = docs.select(
        doc_id.alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        place(key, tree).alias("shard"),
        place(key, grown).alias("grown_shard"),
    )
    out = numbered(rows, "shard", ["doc_id", "text_crc32", "size"])
    return out.select(
        F.col("doc_id").alias(id_col), "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
