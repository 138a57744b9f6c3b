"""Ids must be those of ``tokenizers`` for every text."""

from __future__ import annotations

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from snapharbor.llm import bytebpe
from snapharbor.llm.bytebpe import ByteBpe

TRICKY = [
    "", "a", "Hello  world\n\n x", "<|endoftext|>", "ab<|endoftext|> c", "<|endof", "é​日本 😀  \t\r\n", "  lead",
    " \n \n a", "'s 's'LL", " ", "1234567 89", "x" * 3000, "\x00\x01", "   <|endoftext|>   ", "\x1c\x1d\x1e\x1f \x85",
]


@pytest.fixture(scope="module")
def both():
    path = public_tokenizers.path("byte_bpe_50k.json")
    marked, plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    with open(path, encoding="utf-8") as f:
        return ByteBpe(f.read()), marked, plain


def check(both, text):
    own, marked, plain = both
    assert own.ids(text).tolist() == marked.encode(text, add_special_tokens=False).ids
    assert own.plain(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_tricky_texts(both):
    for text in TRICKY:
        check(both, text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(), st.sampled_from(["<|endoftext|>", " ", "\n", " 　", "it's", "12"])), max_size=20))
def test_random_unicode(both, parts):
    check(both, "".join(parts))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([" ", "\t", "\n", "\xa0", "　", "\x1c", "a", ".", "<|endoftext|>", "   ", " " * 5]), max_size=30))
def test_runs_are_cut_where_the_pattern_cuts(both, parts):
    """With a small limit, every run takes the way of the long ones."""
    own, marked, plain = both
    short, own.long_run = own.long_run, bytebpe.re.compile(f"[{bytebpe.WHITE_SPACE}]{{2,}}")
    try:
        check(both, "".join(parts))
    finally:
        own.long_run = short


@pytest.mark.parametrize("letter", [" ", "\n", "\t", "\xa0", "　", "a", "1", "."])
def test_very_long_runs(both, letter):
    check(both, letter * 2_000_000)
    check(both, "x" + letter * 1_200_000 + "y<|endoftext|>" + letter * 5000 + "<|endoftext|>")


def test_every_character(both):
    """Each code point after a letter, after a blank and before a digit."""
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for a in range(0, len(points), 4000):
        check(both, "".join(f"a{chr(c)} {chr(c)}1" for c in points[a : a + 4000]))
