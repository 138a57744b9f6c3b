from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from helpers import documents, words
from snapharbor.llm import gru, lm
from snapharbor.llm.lm import Settings, score_documents


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


@pytest.fixture(scope="module")
def corpus():
    """Two languages: within one text all words are of one of them."""
    rng = np.random.default_rng(6)
    rows = []
    for k in range(700):
        tongue = "ab"[k % 2]
        rare = [f"rare{rng.integers(10**5)}" for _ in range(3)]
        rows.append((k, " ".join([f"{tongue}{int(x)}" for x in rng.exponential(8, int(rng.integers(3, 80)))] + rare)))
    rows += [(2000, None), (2001, ""), (2002, "\n"), (None, "a1 A1 b1"), (3, "again a1"), (3, "again a1")]
    rows += [(2003, "a1 " * 20000), (2004, "é É unheard"), (2005, "a" * 40000)]
    return rows


SMALL = Settings(known=128, hidden=8, rounds=2, parts=2, group=16)


def test_base_scores_and_counts(spark, corpus, monkeypatch):
    monkeypatch.setattr(lm.lexicon, "__defaults__", (100,))  # so that words are joined as well
    out = score_documents(documents(spark, corpus, clashing=True), SMALL).collect()
    count = Counter()
    for doc_id, text in corpus:
        if not held(doc_id):
            count.update([*words(text), ""])
    n, v = sum(count.values()), len(count)
    want = sorted(
        (
            str(doc_id), held(doc_id), len(w := [*words(text), ""]), sum(count[x] > 0 for x in w), n,
            round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), 5),
        )
        for doc_id, text in corpus
    )
    got = sorted(
        (str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in out
    )
    assert got == want
    tested = [r for r in out if r.held_out and r.doc_id < 1000]
    assert len(tested) > 50 and all(r.score < 0 for r in out)
    assert sum(r.score for r in tested) > sum(r.base_score for r in tested) * 0.97


def test_probabilities_sum_to_one():
    """Over every token that can follow, known ones, and the class of all others."""
    rng = np.random.default_rng(0)
    model = gru.fresh(rng.integers(1, 50, 129), 4)
    for a in model.arrays():
        a += (rng.standard_normal(a.shape) * 0.3).astype(np.float32)
    prefix = [5, 70, 128, 3]
    ends = [np.array([*prefix, t]) for t in range(129)]
    tokens = np.concatenate(ends)
    first, size = np.arange(129) * 5, np.full(129, 5)
    whole = gru.log_likelihood(model, tokens, first, size)
    start = gru.log_likelihood(model, np.array(prefix), np.array([0]), np.array([4]))
    assert abs(np.exp(whole - start).sum() - 1) < 1e-4


def test_state_is_carried_across_windows(monkeypatch):
    rng = np.random.default_rng(1)
    model = gru.fresh(rng.integers(1, 50, 129), 4)
    for a in model.arrays():
        a += (rng.standard_normal(a.shape) * 0.3).astype(np.float32)
    tokens = rng.integers(0, 129, 200)
    first, size = np.array([0, 120, 150]), np.array([120, 30, 50])
    short = gru.log_likelihood(model, tokens, first, size)
    monkeypatch.setattr(gru, "WINDOW", 500)
    assert np.allclose(short, gru.log_likelihood(model, tokens, first, size), atol=1e-3)
    monkeypatch.setattr(gru, "WINDOW", 1)
    assert np.allclose(short, gru.log_likelihood(model, tokens, first, size, group=1), atol=1e-3)


def test_gradients():
    rng = np.random.default_rng(0)
    model = gru.Model(*(a.astype(float) + 0.3 * rng.standard_normal(a.shape) for a in gru.fresh(rng.integers(1, 50, 129), 4).arrays()))
    size = np.array([9, 7, 7, 3, 1])
    tokens, first = rng.integers(0, 129, size.sum()), np.cumsum(size) - size
    inputs, targets, active = next(gru.windows(tokens, first, size))

    def loss():
        _, run = gru.forward(model, np.zeros((5, 4)), inputs, targets, active, True)
        return -gru.outputs(model, run)[0].sum()

    grads = gru.Model(*(np.zeros_like(a) for a in model.arrays()))
    _, run = gru.forward(model, np.zeros((5, 4)), inputs, targets, active, True)
    _, dh = gru.outputs(model, run, grads)
    gru.backward(model, run, dh, grads)
    for value, grad in zip(model.arrays(), grads.arrays()):
        for at in np.argwhere(grad != 0)[:: max(1, (grad != 0).sum() // 7)]:
            at, old = tuple(at), value[tuple(at)]
            value[at] = old + 1e-5
            up = loss()
            value[at] = old - 1e-5
            down = loss()
            value[at] = old
            assert abs((up - down) / 2e-5 - grad[at]) < 1e-3 * max(1, abs(grad[at]))


def test_rounds_go_over_every_training_row(spark, monkeypatch):
    """Also a hot group of equal texts, which is spread over the rounds."""
    rows = [(k, "hot text" if k % 3 else f"own words {k}") for k in range(300)] + [(None, "hot text"), (1, "hot text")]
    seen, of_round = [], lm.rows_of_round

    def noted(*args):
        part = of_round(*args)
        seen.append([r.text for r in part.collect()])
        return part

    monkeypatch.setattr(lm, "rows_of_round", noted)
    score_documents(documents(spark, rows), Settings(known=128, hidden=4)).collect()
    assert Counter(t for part in seen for t in part) == Counter(t for i, t in rows if not held(i))
    assert sum("hot text" in part for part in seen) == len(seen) == Settings().rounds
    with pytest.raises(ValueError):
        Settings(rounds=3, parts=16)


def test_finder():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 63, 500, dtype=np.uint64) << np.uint64(1))
    finder = lm.Finder(keys)
    assert finder.find(keys).tolist() == list(range(len(keys)))
    assert finder.find(keys + np.uint64(1)).tolist() == [-1] * len(keys)
    assert lm.Finder(keys[:0]).find(keys).tolist() == [-1] * len(keys)


def test_small_and_empty_tables(spark):
    assert score_documents(documents(spark, []), SMALL).collect() == []
    only_held = next(k for k in range(100) if held(k))
    (row,) = score_documents(documents(spark, [(only_held, "some words")]), SMALL).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)
    (row,) = score_documents(documents(spark, [(None, None)]), SMALL).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (1, 1, 1)
