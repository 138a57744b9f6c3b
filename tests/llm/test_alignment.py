from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from helpers import collected, documents, prose
from snapharbor.llm import alignment
from snapharbor.llm.alignment import align
from snapharbor.llm.bytebpe import byte_letters
from snapharbor.llm.perfecthash import PerfectHash

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=400))
def test_perfect_hash_numbers_the_keys(keys):
    keys = np.array(sorted(keys), np.uint64)
    hash_ = PerfectHash.of(keys)
    assert sorted(hash_.index(keys).tolist()) == list(range(len(keys)))
    again = PerfectHash.from_bytes(hash_.to_bytes())
    assert again.index(keys).tolist() == hash_.index(keys).tolist() and len(again) == len(keys)


def test_perfect_hash_of_many_keys_is_small():
    keys = np.random.default_rng(0).integers(0, 2**62, 100_000).astype(np.uint64)
    hash_ = PerfectHash.of(np.unique(keys))
    assert sorted(hash_.index(np.unique(keys)).tolist()) == list(range(len(np.unique(keys))))
    assert 8 * len(hash_.to_bytes()) < 6 * len(keys)
    foreign = np.setdiff1d(np.arange(1000, dtype=np.uint64), keys)
    assert (hash_.index(foreign) < len(keys)).all()


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def plain(rows, tokenizers):
    """Ranges of every token, and every pair of tokens compared."""
    a, b = tokenizers
    letters = byte_letters()
    texts = []
    for _, text in rows:
        spans = []
        if text:
            line = " " + text
            ids = a.encode(line, add_special_tokens=False).ids
            spans.append([(i, bytes(letters[c] for c in a.id_to_token(i))) for i in ids])
            pieces = [(i, b.id_to_piece(i)) for i in b.encode(text)]
            spans.append([(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces])
            if any(b"".join(t for _, t in s) != line.encode() for s in spans):
                spans = []
        placed = []
        for side in spans:
            at, out = 0, []
            for i, t in side:
                out.append((i, at, at + len(t)))
                at += len(t)
            placed.append(out)
        texts.append(placed or [[], []])
    links = [[(x, y) for x, s, e in left for y, t, f in right if s < f and t < e] for left, right in texts]
    count = Counter(pair for some in links for pair in set(some))
    highest = {}
    for (x, _), n in count.items():
        highest[x] = max(n, highest.get(x, 0))
    out = []
    for (doc_id, _), (left, right), some in zip(rows, texts, links):
        ends = sorted({e for _, _, e in left} & {e for _, _, e in right})
        groups, start = [], 0
        for end in ends:
            parts = [",".join(str(i) for i, s, _ in side if start <= s < end) for side in (left, right)]
            groups.append("|".join(parts))
            start = end
        best = sum(count[p] == highest[p[0]] for p in some)
        out.append((doc_id, len(left), len(right), len(ends), len(some), best, sum(count[p] for p in some), ";".join(groups)))
    return sorted(out, key=str)


AWKWARD = [
    (1, None), (2, ""), (3, " "), (4, "  two  blanks "), (5, "<|endoftext|></s><unk><0x0A>"), (6, "日本語のテキスト。é​😀\n\t"),
    (7, "▁ piece mark"), (8, "\x00\x01 nul"), (9, "ﬁ ligature ①"), (None, "no id"), (4, "  two  blanks "), (10, "a" * 500), (11, "\xa0　 x"),
]


def corpus():
    rng = np.random.default_rng(1)
    return [(100 + k, prose(rng, int(n)) + " The Quick, brown-fox's jumped; naïve 1234!") for k, n in enumerate(rng.integers(0, 40, 40))] + AWKWARD


def test_equals_plain_alignment(spark, tokenizers):
    rows = corpus()
    found = align(documents(spark, rows, clashing=True), with_links=True)
    want = plain(rows, tokenizers)
    assert collected(found, *COLUMNS) == want
    for r in found.collect():
        assert len(r.links) == r.n_links and sum(x["count"] for x in r.links) == r.count_sum
    # some texts are not spelled by the second tokenizer
    assert [r[7] for r in want if r[0] == 7] == [""]


def test_many_small_parts_and_blocks_give_the_same(spark, tokenizers, monkeypatch):
    rows = corpus()
    for name, value in {"PART_PAIRS": 16, "BLOCK_PARTS": 7, "HELD_VECTORS": 2, "HELD_PAIRS": 50}.items():
        monkeypatch.setattr(alignment, name, value)
    assert collected(align(documents(spark, rows)), *COLUMNS) == plain(rows, tokenizers)


def test_hash_of_the_groups(spark):
    from pyspark.sql import functions as F

    row = align(documents(spark, [(1, "Hello there")])).withColumn("h", F.sha2("groups", 256)).first()
    assert row.h == hashlib.sha256(row.groups.encode()).hexdigest() and row.n_groups == row.groups.count(";") + 1


def test_very_long_run_and_empty_table(spark):
    assert align(documents(spark, [])).collect() == []
    row = align(documents(spark, [(1, "x" + " " * 1_200_000 + "y")])).first()
    assert row.n_a > 1_000_000 and row.n_links >= row.n_a and row.n_groups <= row.n_b
