from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import collected, documents, prose, words
from snapharbor.llm.components import components
from snapharbor.llm.jaccard import keep_first, most_shared, outline, shingle_classes
from snapharbor.llm.textbytes import Shingles, Words


def brute(rows, n=4, num=85, den=100):
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and den * both >= num * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            k = find(i)
            least[k] = min(least.get(k, doc_id), doc_id)
    return [
        (doc_id, len(sets[i]), least.get(find(i)) if sets[i] else doc_id) for i, (doc_id, _) in enumerate(rows)
    ]


def family(rng, first, size, length, edits):
    """Copies of one text with some words changed."""
    base = prose(rng, length).split()
    out = []
    for k in range(size):
        w = list(base)
        for at in rng.integers(0, length, edits):
            w[at] = f"x{rng.integers(10**6)}"
        out.append((first + k, " ".join(w)))
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(5)
    line = prose(rng, 60)
    rows = family(rng, 0, 40, 200, 3) + family(rng, 100, 25, 120, 4) + family(rng, 200, 12, 30, 1)
    rows += [(300 + k, f"{line} {prose(rng, 20 + k)}") for k in range(40)]  # one passage in many
    rows += [(400 + k, "Same text over and over again here") for k in range(30)]  # exact copies
    rows += [(500, None), (501, ""), (502, " \t\n\x0b "), (503, "one"), (504, "ONE"), (505, "two words"), (506, "Two  Words")]
    rows += [(507, prose(rng, 20000)), (508, "ha " * 500), (509, "ha " * 700), (None, "Same text over and over again here")]
    rows += [(None, "no id at all but some words"), (510, "É é À"), (511, "é é À"), (503, "one"), (512, "a" * 50000)]
    return rows


def test_classes_match_brute_force(spark, corpus):
    got = collected(shingle_classes(documents(spark, corpus, clashing=True)))
    assert got == sorted(brute(corpus), key=str)


def test_other_rule(spark, corpus):
    got = collected(shingle_classes(documents(spark, corpus), words=5, threshold="0.8"))
    assert got == sorted(brute(corpus, 5, 80, 100), key=str)


def test_order_hint_changes_nothing(spark, corpus, monkeypatch):
    import snapharbor.llm.jaccard as module

    monkeypatch.setattr(module, "COUNT_LEAST", 2)
    monkeypatch.setattr(module, "COUNT_BLOCK", 1000)
    got = collected(shingle_classes(documents(spark, corpus)))
    assert got == sorted(brute(corpus), key=str)


def test_empty_table(spark):
    assert shingle_classes(documents(spark, [])).collect() == []
    assert keep_first(documents(spark, [])).collect() == []


def first_of_classes(rows):
    """(id, text) that stay: of each class by rows the smallest id, nulls last, then the first row."""
    numbered = [(k, t) for k, (_, t) in enumerate(rows)]
    classes = {}
    for k, n, c in brute(numbered, 5, 80, 100):
        classes.setdefault(c if n else ("alone", k), []).append(k)
    kept = [min(ks, key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k)) for ks in classes.values()]
    return sorted((rows[k] for k in kept), key=str)


def test_keep_first_keeps_one_of_each_class(spark, corpus):
    docs = documents(spark, corpus, clashing=True)
    kept = keep_first(docs)
    assert kept.columns == docs.columns
    assert collected(kept, "doc_id", "text") == first_of_classes(corpus)


def test_repeated_and_null_ids_hide_no_copy(spark):
    text, other = " ".join(f"w{k}" for k in range(60)), " ".join(f"v{k}" for k in range(60))
    near = text + " more"
    rows = [(None, text), (None, text), (5, other), (5, other + " x"), (9, "a b c d e f"), (9, near), (2, near), (7, None), (7, ""), (None, text)]
    want = first_of_classes(rows)
    assert collected(keep_first(documents(spark, rows)), "doc_id", "text") == want
    assert want == sorted([(2, near), (5, other), (9, "a b c d e f"), (7, None), (7, "")], key=str)


def test_words_and_shingles_match_plain_python():
    import pyarrow as pa

    texts = ["A bc\td", "", None, "é È longer-than-eight-bytes\x0bz", "x", " lead and trail ", "a b c d e f"]
    found = Words(pa.array(texts))
    got = [[found.word(j) for j in range(found.first[i], found.first[i + 1])] for i in range(found.rows)]
    assert got == [words(t) for t in texts]
    sizes = Shingles(pa.array(texts), 4).sizes.tolist()
    assert sizes == [1, 0, 0, 1, 1, 1, 3]
    sliced = pa.array(["zz zz", *texts]).slice(1)
    assert Words(sliced).hashes.tolist() == found.hashes.tolist()


def test_outlines_never_rule_out_what_is_shared():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 300), dtype=np.uint64))
        b = np.unique(np.concatenate([rng.choice(a, rng.integers(1, len(a) + 1)), rng.integers(0, 1 << 63, 20, dtype=np.uint64)]))
        assert most_shared(outline(a), len(a), outline(b), len(b)) >= len(np.intersect1d(a, b))


def test_components_of_a_chain_a_star_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (1, 0), (200, 200)]
    got = dict(components(spark.createDataFrame(links, "x bigint, y bigint")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + k: 100 for k in range(30)}}


@pytest.mark.parametrize(("entries", "products"), [(3, 1 << 20), (20_000, 7), (6, 5)])
def test_blocks_and_joined_lists_agree(spark, corpus, monkeypatch, entries, products):
    """Long lists are joined, others multiplied in blocks: any border gives the same classes."""
    import snapharbor.llm.jaccard as module

    monkeypatch.setattr(module, "BLOCK_ENTRIES", entries)
    monkeypatch.setattr(module, "PRODUCTS", products)
    rows = corpus[:77] + corpus[-20:]
    got = collected(shingle_classes(documents(spark, rows)))
    assert got == sorted(brute(rows), key=str)
