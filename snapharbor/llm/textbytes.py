"""Words and word n-grams of whole texts, computed on bytes with numpy.

A word is a longest run of bytes other than 0x20 and 0x09-0x0D; only A-Z are lower-cased.
UTF-8 never uses those bytes inside a longer character, so this is the same as
working on characters. Words and n-grams are identified by 64-bit hashes.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
# Masks for the first 0 to 8 bytes of a little-endian 64-bit value.
_FIRST = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_SIZE = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (murmur3's finalizer, a bijection)."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(33))
        h = h * np.uint64(0xFF51AFD7ED558CCD)
        h = h ^ (h >> np.uint64(33))
        h = h * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(33))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


# Scripts that are written without spaces (fixed values: blocks of Unicode): Han, Kana, Bopomofo,
# Thai, Lao, Tibetan, Myanmar, Khmer.
UNSPACED = (
    (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF), (0x3040, 0x30FF), (0x31F0, 0x31FF),
    (0xFF66, 0xFF9D), (0x3100, 0x312F), (0x0E00, 0x0EFF), (0x0F00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF),
)


def _ranges(points: list[int]) -> str:
    """The points as the inside of a character class."""
    out, start = [], None
    for here, after in zip(points, [*points[1:], -1]):
        start = here if start is None else start
        if after != here + 1:
            out.append(chr(start) + "-" + chr(here))
            start = None
    return "".join(out)


def segmenting() -> tuple[re.Pattern, re.Pattern]:
    """Patterns for ``segmented``, found once on the driver: marks and spaces beyond ASCII (Unicode's P, S, Z and C but private ones), and characters of
    unspaced scripts."""
    parting = [
        p
        for p in range(0x80, 0x110000)
        if not 0xD800 <= p < 0xE000 and (c := unicodedata.category(chr(p)))[0] in "PSZC" and c not in ("Cn", "Co")
    ]
    unspaced = "".join(f"{chr(a)}-{chr(b)}" for a, b in UNSPACED)
    return re.compile(f"[{_ranges(parting)}]"), re.compile(f"[{unspaced}]")


def segmented(column: pa.Array, patterns: tuple[re.Pattern, re.Pattern]) -> pa.Array:
    """Texts whose marks and spaces beyond ASCII are blanks and whose characters of scripts without
    spaces stand between blanks."""
    data, _ = text_bytes(column)
    if not len(data) or data.max() < 128:
        return column
    marks, unspaced = patterns
    out = []
    for text in column.to_pylist():
        if text and not text.isascii():
            if marks.search(text):
                text = marks.sub(" ", text)
            if unspaced.search(text):
                text = unspaced.sub(lambda m: f" {m.group()} ", text)
        out.append(text)
    return pa.array(out, pa.large_string())


def slices(column: pa.Array, target: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``target`` bytes each; one long text is a range of its own."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start, size = 0, 0
    for i, n in enumerate(lengths):
        if i > start and size + n > target:
            yield start, i
            start, size = i, 0
        size += int(n)
    if start < len(lengths):
        yield start, len(lengths)


def word_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings at ``starts``, eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.lib.stride_tricks.as_strided(padded.view(np.uint8)[:8].view("<u8"), (len(data) + 1,), (1,))
    with np.errstate(over="ignore"):
        h = mix((eights[starts] & _FIRST[np.minimum(sizes, 8)]) ^ (sizes.astype(np.uint64) * _SIZE))
        at, done = np.flatnonzero(sizes > 8), 8
        while len(at):
            rest = np.minimum(sizes[at] - done, 8)
            h[at] = mix(h[at] * _STEP + (eights[starts[at] + done] & _FIRST[rest]))
            done += 8
            at = at[sizes[at] > done]
    return h


class Words:
    """Words of some texts: ``hashes`` in text order, row i's are [first[i], first[i+1])."""

    def __init__(self, column: pa.Array, fold: bool = True, marks: bool = False, parts: np.ndarray | None = None):
        """With ``marks``, ASCII punctuation and control characters part words too; ``parts``
        says for each byte value whether it parts words, instead."""
        data, offsets = text_bytes(column)
        self.rows = len(offsets) - 1
        # 0x20 and 0x09-0x0D; the subtraction wraps around for smaller bytes
        if parts is not None:
            solid = ~parts[data]
        else:
            solid = _LETTER[data] if marks else (data != 0x20) & ((data - np.uint8(9)) > np.uint8(4))
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        begins[edges] = solid[edges]
        self.starts = np.flatnonzero(begins)
        finishes = solid.copy()
        finishes[:-1] &= ~solid[1:]
        finishes[edges - 1] = solid[edges - 1]
        self.ends = np.flatnonzero(finishes) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.offsets = offsets
        self.data = _LOWER[data] if fold else data
        self.hashes = word_hashes(self.data, self.starts, self.ends - self.starts)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.first))

    def word(self, i: int) -> str:
        return self.data[self.starts[i] : self.ends[i]].tobytes().decode()


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:count].copy()
    with np.errstate(over="ignore"):
        for k in range(1, n):
            total = total * _STEP + hashes[k : k + count]
    return mix(total + np.uint64(n))


class Shingles:
    """Sorted distinct n-word shingles of some texts: row i's are grams[ends[i]:ends[i+1]].

    A text with fewer than n words, but one at least, has all its words as its only shingle.
    ``signature`` is 64 bits that tell sets apart.
    """

    def __init__(self, column: pa.Array, n: int):
        found = Words(column)
        count = np.diff(found.first)
        sizes = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
        row = found.row_of_word()
        grams = np.zeros(int(sizes.sum()), np.uint64)
        long_row = np.repeat(count >= n, sizes)
        windows = ngrams(found.hashes, n)
        if len(windows):
            grams[long_row] = windows[row[n - 1 :] == row[: len(windows)]]
        short = np.flatnonzero((count > 0) & (count < n))
        grams[~long_row] = [ngrams(found.hashes[found.first[i] : found.first[i + 1]], int(count[i]))[0] for i in short]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
            grams[a:b].sort()
        new = np.ones(len(grams), bool)
        new[1:] = grams[1:] != grams[:-1]
        new[ends[:-1][sizes > 0]] = True
        self.grams = grams[new]
        self.sizes = np.zeros(found.rows, np.int64)
        self.signature = np.zeros(found.rows, np.int64)
        full = sizes > 0
        if full.any():
            self.sizes[full] = np.add.reduceat(new.astype(np.int64), ends[:-1][full])
        self.ends = np.concatenate([[0], np.cumsum(self.sizes)])
        if full.any():
            with np.errstate(over="ignore"):
                sums = np.add.reduceat(mix(self.grams ^ _SIZE), self.ends[:-1][full])
                self.signature[full] = signed(mix(sums + self.sizes[full].astype(np.uint64)))

    def row(self, i: int) -> np.ndarray:
        return self.grams[self.ends[i] : self.ends[i + 1]]


def signed(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h).view(np.int64)
