from __future__ import annotations

import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import collected, documents, prose
from snapharbor.llm.tiling import drop_leaks, leaks, tiles


def plain_tiles(a, b, least):
    """Greedy string tiling by looking at every pair of places in every round."""
    free_a, free_b = [True] * len(a), [True] * len(b)
    total = []
    while True:
        best, found = least - 1, []
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and free_a[i + n] and free_b[j + n] and a[i + n] == b[j + n]:
                    n += 1
                if n > best:
                    best, found = n, [(i, j)]
                elif n == best and n >= least:
                    found.append((i, j))
        if not found:
            return total
        for i, j in found:
            if all(free_a[i : i + best]) and all(free_b[j : j + best]):
                free_a[i : i + best] = free_b[j : j + best] = [False] * best
                total.append((best, i, j))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.lists(st.integers(0, 3), max_size=40), st.integers(1, 4))
def test_tiling_is_greedy_and_complete(a, b, least):
    got = tiles(a, b, [True] * len(a), least)
    used_a, used_b = [0] * len(a), [0] * len(b)
    for n, i, j in got:
        assert n >= least and a[i : i + n] == b[j : j + n]
        for k in range(n):
            used_a[i + k] += 1
            used_b[j + k] += 1
    assert max(used_a, default=0) <= 1 and max(used_b, default=0) <= 1
    for i in range(len(a) - least + 1):  # nothing of the least length is left over
        for j in range(len(b) - least + 1):
            if not any(used_a[i : i + least]) and not any(used_b[j : j + least]):
                assert a[i : i + least] != b[j : j + least]
    want = plain_tiles(a, b, least)
    assert max(got, default=(0,))[0] == max(want, default=(0,))[0]


def test_tiling_matches_plain_on_distinct_passages():
    rng = np.random.default_rng(4)
    for _ in range(50):
        b = rng.integers(0, 10**6, 40).tolist()
        cut = sorted(rng.integers(5, 35, 2).tolist())
        a = [*rng.integers(0, 10**6, 10).tolist(), *b[cut[1] :], 1, *b[: cut[0]], 2, *b[cut[0] : cut[1]]]
        assert sorted(tiles(a, b, [True] * len(a), 4)) == sorted(plain_tiles(a, b, 4))


def tokens(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub(r"[A-Z]", lambda m: m.group().lower(), text or ""))


@pytest.fixture(scope="module")
def bench(spark):
    rng = np.random.default_rng(9)
    items = [(k, prose(rng, 30 + k, 10**5)) for k in range(12)] + [(50, "Tiny item"), (51, None), (52, ""), (53, "?!")]
    items += [(None, prose(rng, 25, 10**5)), (3, prose(rng, 25, 10**5))]
    return items


@pytest.fixture(scope="module")
def corpus(bench):
    rng = np.random.default_rng(10)
    w = bench[0][1].split()
    rows = [(k, prose(rng, 200, 10**5)) for k in range(30)]
    rows += [(100, prose(rng, 50, 10**5) + " " + bench[1][1].upper() + ". End")]  # whole, other case
    rows += [(101, " ".join(w[20:] + ["x"] + w[:10] + ["y"] + w[10:20]))]  # reordered
    rows += [(102, " ".join(w[:10]) + " other words")]  # a third of it only
    rows += [(103, "a tiny, ITEM here"), (104, "tiny thing item"), (105, None), (106, ""), (107, "...")]
    rows += [(108, prose(rng, 20000, 10**5) + " " + bench[2][1]), (None, bench[2][1]), (109, bench[2][1]), (109, bench[2][1])]
    rows += [(110, bench[-1][1]), (111, bench[-2][1]), (112, " ".join([w[0]] * 3000))]
    return rows


def brute(rows, items, least=4, coverage=0.5):
    out = []
    for doc_id, text in rows:
        a = tokens(text)
        for item_id, item in items:
            b = tokens(item)
            if b:
                share = sum(n for n, _, _ in plain_tiles(a, b, min(least, len(b)))) / len(b) if len(a) < 3000 else None
                if share is None:
                    share = 1.0 if " ".join(b) in " ".join(a) else 0.0
                if share >= coverage:
                    out.append((doc_id, item_id, round(share, 9)))
    return sorted(out, key=str)


def frame(spark, items):
    return spark.createDataFrame([(*x, "more") for x in items], "item_id bigint, text string, row string")


@pytest.mark.parametrize("block_tokens", [2_000_000, 200])
def test_leaks_match_brute_force(spark, bench, corpus, block_tokens):
    found = leaks(documents(spark, corpus, clashing=True), frame(spark, bench), block_tokens=block_tokens)
    got = sorted(((r.doc_id, r.item_id, round(r.coverage, 9)) for r in found.collect()), key=str)
    assert got == brute(corpus, bench)
    # two words tell nothing about a document
    assert all(r.contaminated == (r.item_id != 50) and r.contaminated == (r.matched >= 8) for r in found.collect())


def test_leaking_rows_go_and_others_stay(spark, bench, corpus):
    docs = documents(spark, corpus, clashing=True)
    bad = {x[0] for x in brute(corpus, bench) if x[1] != 50}
    kept = drop_leaks(docs, frame(spark, bench))
    assert kept.columns == docs.columns
    assert collected(kept, "doc_id", "text", "row") == sorted(
        ((i, t, f"row{i}") for i, t in corpus if i not in bad), key=str
    )


def test_short_items_contaminate_nothing(spark):
    items = [(1, "yes"), (2, "what is the capital of France today"), (3, "one two three four five six seven eight nine")]
    rows = [(1, "I said yes to it"), (2, "what is the capital here"), (3, "one two three four five six seven eight")]
    found = leaks(documents(spark, rows), frame(spark, items))
    assert collected(found, "doc_id", "item_id", "contaminated") == [(1, 1, False), (2, 2, False), (3, 3, True)]
    assert collected(drop_leaks(documents(spark, rows), frame(spark, items)), "doc_id") == [(1,), (2,)]


def test_scripts_without_spaces_and_other_marks(spark):
    chinese = "人工智能是计算机科学的一个分支,它企图了解智能的实质"
    thai = "ภาษาไทยเป็นภาษาที่มีระดับเสียง"
    french = "il était une fois dans un pays très lointain une reine qui aimait les pommes"
    items = [(1, chinese), (2, thai), (3, french)]
    rows = [
        (1, "今天天气很好。" + chinese.replace(",", ",") + "。明天再说"), (2, "ก่อนหน้า" + thai + "ต่อไป"),
        (3, "« " + french.replace(" ", "\u00a0").replace("lointain", "lointain\u2014") + " »"), (4, "今天天气很好,明天再说"),
    ]
    found = leaks(documents(spark, rows), frame(spark, items))
    assert collected(found, "doc_id", "item_id", "contaminated") == [(1, 1, True), (2, 2, True), (3, 3, True)]


def test_empty_tables(spark, bench, corpus):
    assert leaks(documents(spark, []), frame(spark, bench)).collect() == []
    assert leaks(documents(spark, corpus), frame(spark, [])).collect() == []
    assert drop_leaks(documents(spark, corpus), frame(spark, [])).count() == len(corpus)
