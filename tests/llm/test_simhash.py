from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import collected, documents, prose, words
from snapharbor.llm import simhash
from snapharbor.llm.simhash import close_lanes, close_links, fingerprints, links_in_cells, packed, planes, simhash_classes, subtables, tables


def plain_print(text, n=3):
    w = words(text)
    shingles = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(values, radius):
    """Component of each value by comparing all pairs."""
    root = list(range(len(values)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(values))]


TEXTS = ["", None, " \t\n", "One", "one  TWO", "a b c", "A\x0bb\x0cc", "é 日本 \x85 x", "x\xa0y z w", "the the the the the", "\x1c a \x00 b c d"]


def test_fingerprints_equal_plain_ones():
    rng = np.random.default_rng(0)
    texts = TEXTS + [prose(rng, int(n)) for n in rng.integers(0, 300, 40)] + ["x" * 3000 + " y z " * 500]
    found = fingerprints(pa.array(texts, pa.string()), 3)
    assert found.tolist() == [plain_print(t) for t in texts]
    assert fingerprints(pa.array([], pa.string()), 3).tolist() == []


def test_long_text_is_hashed_whole(monkeypatch):
    text = prose(np.random.default_rng(1), 5000)
    monkeypatch.setattr(simhash, "SHINGLES", 64)
    assert fingerprints(pa.array([text]), 3).tolist() == [plain_print(text)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=2, max_size=200), st.integers(0, 5), st.integers(1, 190), st.randoms())
def test_bit_sliced_distances(values, radius, shift, random):
    # near values, so that some distances are small
    values = [v if random.random() < 0.3 else values[0] ^ (1 << random.randrange(64)) ^ (1 << random.randrange(64)) for v in values]
    shift = min(shift, len(values) - 1)
    array = np.array(values, np.uint64)
    bits = planes(array, shift)
    asked = packed(np.arange(len(values)) < len(values) - shift)
    want = [i for i in range(len(values) - shift) if (values[i] ^ values[i + shift]).bit_count() <= radius]
    assert close_lanes(bits, asked, shift, radius).tolist() == want


@pytest.mark.parametrize("radius", [0, 1, 3, 7])
def test_tables_cover_every_pair_within_the_radius(radius):
    rng = np.random.default_rng(radius)
    for _ in range(300):
        bits = rng.choice(64, radius, replace=False)
        difference = sum(1 << int(b) for b in bits)
        hit = [mask for mask in tables(radius) if not mask & difference]
        assert hit
        assert all(any(not sub & difference for sub in subtables(mask, radius)) for mask in hit)


def family(rng, n, spread):
    centre = int(rng.integers(0, 2**63))
    return [centre ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, spread)), replace=False)) for _ in range(n)]


def test_forest_of_a_cell_connects_all_links():
    rng = np.random.default_rng(5)
    values = np.array(family(rng, 150, 6) + family(rng, 90, 4) + [int(v) for v in rng.integers(0, 2**63, 80)], np.uint64)
    cells = np.sort(rng.integers(0, 3, len(values)))
    x, y = links_in_cells(cells, values, 3)
    for cell in range(3):
        some = sorted({int(v) for v in values[cells == cell]})
        want = plain_roots(some, 3)
        place = {v: i for i, v in enumerate(some)}
        root = list(range(len(some)))

        def top(i):
            while root[i] != i:
                i = root[i]
            return i

        for a, b in zip(x.tolist(), y.tolist()):
            if a in place and b in place:
                assert (a ^ b).bit_count() <= 3
                i, j = sorted((top(place[a]), top(place[b])))
                root[j] = i
        assert [top(i) for i in range(len(some))] == want
    assert len(x) <= len(values)


@pytest.mark.parametrize("most", [2048, 20])
def test_links_of_large_families(spark, most):
    """With small cells, the finer tables and the squares of chunks are used."""
    rng = np.random.default_rng(9)
    values = sorted(set(family(rng, 200, 5) + family(rng, 60, 12) + [int(v) for v in rng.integers(0, 2**63, 150)] + [0, 2**64 - 1, 1, 2**63]))
    rows = [(v - 2**64 if v >> 63 else v,) for v in values]
    links = close_links(spark.createDataFrame(rows, "print bigint"), 3, most).collect()
    place = {v[0]: i for i, v in enumerate(rows)}
    root = list(range(len(values)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for r in links:
        assert (values[place[r.x]] ^ values[place[r.y]]).bit_count() <= 3
        i, j = sorted((top(place[r.x]), top(place[r.y])))
        root[j] = i
    assert [top(i) for i in range(len(values))] == plain_roots(values, 3)


def test_classes_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    base = [prose(rng, 200) for _ in range(6)]
    rows = [(k, t) for k, t in enumerate(TEXTS)]
    for k in range(90):
        w = base[k % 6].split(" ")
        for i in rng.integers(0, len(w), k % 5):
            w[int(i)] = f"new{k}"
        rows.append((100 + k, " ".join(w)))
    rows += [(300, base[0]), (300, base[0]), (None, base[1]), (None, "nowhere else in the table at all"), (-5, base[2].upper())]
    found = collected(simhash_classes(documents(spark, rows, clashing=True)))
    prints = [plain_print(t) for _, t in rows]
    roots = plain_roots(prints, 3)
    least = {}
    for (doc_id, _), root in zip(rows, roots):
        if doc_id is not None:
            least[root] = min(doc_id, least.get(root, doc_id))
    want = [(doc_id, f"{p:016x}", least.get(root)) for (doc_id, _), p, root in zip(rows, prints, roots)]
    assert found == sorted(want, key=str)
    assert len(set(roots)) < len(rows) - 40  # most of the near-copies link


def test_empty_table(spark):
    assert simhash_classes(documents(spark, [])).collect() == []
