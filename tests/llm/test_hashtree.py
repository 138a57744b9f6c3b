from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from helpers import documents
from snapharbor.llm.hashtree import layout, place, sharded


def plain_place(key, tree):
    def u(node):
        return (int(hashlib.md5(f"{key}/{node}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48

    def pick(weights):
        return min((-math.log(u(n)) / w, n) for n, w in weights.items() if w > 0)[1]

    racks = tree[pick({r: sum(sum(s.values()) for s in k.values()) for r, k in tree.items()})]
    shards = racks[pick({k: sum(s.values()) for k, s in racks.items()})]
    return int(pick({str(s): w for s, w in shards.items()}))


ROWS = [(k, f"text {k % 7}") for k in range(1200)]
ROWS += [(5, "other text"), (5, "other text"), (None, None), (None, ""), (3000, None), (3001, "é" * 5), (3002, "z" * 100000)]


def test_rows_shards_and_slots(spark):
    tree, grown = layout(8), layout(9)
    out = sharded(documents(spark, ROWS, clashing=True), tree, grown).collect()
    assert len(out) == len(ROWS)
    slots = defaultdict(list)
    for r in out:
        key = "null" if r.doc_id is None else str(r.doc_id)
        assert r.shard == plain_place(key, tree) and r.grown_shard == plain_place(key, grown)
        assert r.grown_shard in (r.shard, 8) and r.law == "key"
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(8))
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in ROWS)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == want


def moves(spark, before, after, n=4000):
    keys = spark.range(n).select(F.col("id").cast("string").alias("k"))
    rows = keys.select(place(F.col("k"), before).alias("a"), place(F.col("k"), after).alias("b"))
    return Counter((r.a, r.b) for r in rows.collect())


def test_weights_are_followed(spark):
    share = Counter()
    for (a, _), n in moves(spark, layout(4, {0: 3.0, 3: 0.0}), layout(4)).items():
        share[a] += n
    assert share[3] == 0 and abs(share[0] / 4000 - 0.6) < 0.03 and abs(share[1] / 4000 - 0.2) < 0.03


def test_movement_stays_in_changed_subtrees(spark):
    heavier = moves(spark, layout(8), layout(8, {1: 2.0}))
    for (a, b), n in heavier.items():
        # into region 0, which grew; within it into rack 0; within that into shard 1
        if a != b:
            assert b < 4 and (a >= 4 or b < 2) and (a >= 2 or b == 1), (a, b, n)
    assert sum(n for (a, b), n in heavier.items() if a != b) < 4000 * 0.25
    for (a, b), _ in moves(spark, layout(8), layout(9)).items():
        assert b in (a, 8)


def test_empty_table(spark):
    assert sharded(documents(spark, []), layout(8), layout(9)).collect() == []
