"""A minimal perfect hash of a set of 64-bit keys, built in levels.

Each level is a bit array about GAMMA times as long as the keys that are left. A key whose place no
other key wants sets its bit and is done; the others go on to the next level. A key's index is
the number of set bits before its own, so n keys get the numbers 0 to n - 1. The structure takes
some four bits a key and does not hold the keys: a foreign key may get an index too, so callers
compare with the key stored at that index.
"""

from __future__ import annotations

import numpy as np

from snapharbor.llm.textbytes import mix

GAMMA = 2.0
_SEED = np.uint64(0x9E3779B97F4A7C15)


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(mix(keys + _SEED * np.uint64(level + 1))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])

    def __len__(self) -> int:
        return int(self.before[-1])

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """Of distinct keys."""
        rest, sizes, levels = keys.astype(np.uint64), [], []
        while len(rest):
            size = -(-int(GAMMA * len(rest)) // 64) * 64
            place = _places(rest, len(sizes), size)
            alone = np.bincount(place, minlength=size)[place] == 1
            flags = np.zeros(size, bool)
            flags[place[alone]] = True
            levels.append(np.packbits(flags, bitorder="little").view(np.uint64))
            sizes.append(size)
            rest = rest[~alone]
        return cls(np.array(sizes, np.int64), np.concatenate(levels) if levels else np.zeros(0, np.uint64))

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 for keys that certainly are not in the set."""
        keys = keys.astype(np.uint64)
        out = np.full(len(keys), -1, np.int64)
        open_, first = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(open_):
                break
            place = first + _places(keys[open_], level, size)
            word, bit = self.bits[place >> 6], (place & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            lower = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[open_[hit]] = (self.before[place >> 6] + np.bitwise_count(lower))[hit]
            open_ = open_[~hit]
            first += size
        return out

    def to_bytes(self) -> bytes:
        return np.concatenate([[len(self.sizes)], self.sizes]).astype("<i8").tobytes() + self.bits.astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        n = int(np.frombuffer(data, "<i8", 1)[0])
        return cls(np.frombuffer(data, "<i8", n, 8), np.frombuffer(data, "<u8", -1, 8 * (n + 1)))
