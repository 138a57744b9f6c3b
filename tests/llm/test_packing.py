from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from helpers import documents, prose
from snapharbor.llm.packing import best_fit, cuts, pack

TRICKY = [
    "", "a", "Hello  world\n\n x", "<|endoftext|>", "ab<|endoftext|> c", "<|endof", "é​日本 😀  \t\r\n", "  lead",
    " \n \n a", "'s 's'LL", " ", "1234567 89", "x" * 3000, "\x00\x01",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_only_the_first_piece_may_be_short():
    assert cuts(5, 8) == [(0, 5)]
    assert cuts(8, 8) == [(0, 8)]
    assert cuts(19, 8) == [(0, 3), (3, 8), (11, 8)]


def one_by_one(counts, capacity):
    """Sequences that best-fit decreasing opens when it places one piece after the other."""
    gaps = []
    for length in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        fitting = [g for g in gaps if g >= length]
        if fitting:
            gaps.remove(min(fitting))
        gaps.append((min(fitting) if fitting else capacity) - length)
    return len(gaps)


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(0, 40), max_size=24))
def test_plan_places_every_piece_once_without_gaps(counts):
    plan, opened = best_fit(counts, 24)
    content, ranks = defaultdict(list), defaultdict(list)
    for length, first, many, sequence, offset in plan:
        for k in range(many):
            ranks[length].append(first + k)
            content[sequence + k].append((offset, length))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items() if c}
    assert len(content) == opened
    for parts in content.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 24
    assert opened <= one_by_one(counts, 24) * 1.1 + 1


def test_pieces_and_sequences(spark, tokenizer):
    rng = np.random.default_rng(3)
    rows = [(k, prose(rng, int(n))) for k, n in enumerate(rng.integers(0, 300, 150))]
    rows += [(1000 + k, t) for k, t in enumerate(TRICKY)] + [(2000, None), (2001, prose(rng, 9000)), (7, "again"), (None, "no id")]
    rows += [(3000 + k, "equal lengths tie") for k in range(40)] + [(3000, "equal lengths tie")]
    out = pack(documents(spark, rows, clashing=True), capacity=256, with_ids=True).collect()
    sequences = defaultdict(list)
    for r in out:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 256
    want = Counter()
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for k, (start, length) in enumerate(cuts(len(ids), 256)):
            want[doc_id, k, start, tuple(ids[start : start + length])] += 1
    assert Counter((r.doc_id, r.piece, r.start, tuple(r.ids)) for r in out) == want
    total = sum(r.length for r in out)
    assert len(sequences) <= -(-total // 256) * 1.05 + 1


def test_a_very_long_run_of_blanks(spark, tokenizer):
    rows = [(1, "a" + " " * 2_000_000 + "b"), (2, "\n" * 1_500_000), (3, "short")]
    out = pack(documents(spark, rows)).collect()
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        found = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in out if r.doc_id == doc_id)
        want = [(k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(cuts(len(ids), 2048))]
        assert found == want


def test_empty_table(spark):
    assert pack(documents(spark, [])).collect() == []
