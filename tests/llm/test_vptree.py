from __future__ import annotations

import numpy as np
import pytest

from snapharbor.llm.vptree import nearest

SCHEMA = "vec_id bigint, embedding array<float>, row string, part string, dim string, v string"


def brute(rows, modulus, k):
    ok = []
    for i, (vec_id, v) in enumerate(rows):
        if vec_id is None or not v or any(x is None for x in v):
            continue
        v = np.array(v, np.float32).astype(float)
        if np.isfinite(v).all() and v.any():
            ok.append((i, vec_id, v))
    out = []
    for i, q_id, q in ok:
        if q_id % modulus:
            continue
        found = []
        for j, c_id, c in ok:
            if i != j and len(c) == len(q):
                score = 0.0
                for a, b in zip(q, c):
                    score += a * b
                found.append((-score, c_id))
        out += [(q_id, r + 1, c, -s) for r, (s, c) in enumerate(sorted(found)[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((8, 12))
    rows = [(k, (centres[k % 8] + 0.3 * rng.standard_normal(12)).astype(np.float32).tolist()) for k in range(1500)]
    rows += [(2000 + k, [0.5] * 12) for k in range(300)]  # a hot vector
    rows += [(3000, None), (3010, [0.0] * 12), (3020, [float("nan")] * 12), (3030, [None] + [1.0] * 11)]
    rows += [(3040, [float("inf")] * 12), (3050, []), (None, [1.0] * 12), (20, [0.1] * 12), (20, [0.1] * 12)]
    rows += [(4000, [1.0, 2.0]), (4001, [2.0, 1.0]), (4020, [1.0] * 3)]  # other lengths
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "r", "p", "d", "v") for i, v in rows], SCHEMA)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_factor_one_is_exact(spark, rows):
    found = nearest(frame(spark, rows), query_modulus=20, neighbours=7, shard_rows=400)
    assert got(found) == brute(rows, 20, 7)


def test_fewer_candidates_than_asked(spark):
    rows = [(k, [float(k), 1.0]) for k in range(5)]
    assert got(nearest(frame(spark, rows), 1, neighbours=20)) == brute(rows, 1, 20)


def test_relaxed_bound_keeps_recall(spark, rows):
    exact = {x[:1] + x[2:3] for x in brute(rows, 20, 7)}
    found = {(r.query_id, r.vec_id) for r in nearest(frame(spark, rows), 20, 7, factor=1.3, shard_rows=400).collect()}
    assert len(exact & found) >= 0.9 * len(exact)


def test_no_vectors(spark):
    assert nearest(frame(spark, [])).collect() == []
    assert nearest(frame(spark, [(20, [0.0, 0.0])])).collect() == []
    assert nearest(frame(spark, [(20, [1.0, 0.0])])).collect() == []
