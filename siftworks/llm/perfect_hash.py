"""A minimal perfect hash over unsigned 64-bit keys, as arrays.

Level by level, each remaining key is hashed into twice as many bits as keys remain; a bit that exactly one key hits is
set and that key is placed. A key's slot is the rank of its bit over all levels. Stored: the bits and a running count
for every 64-bit word, about 5 bits a key. Lookups cost a few hashes whatever the number of keys.
"""

from __future__ import annotations

import io

import numpy as np

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser: a bijection of the keys for each seed."""
    with np.errstate(over="ignore"):
        x = keys + _A * np.uint64(2 * seed + 1)
        x = (x ^ (x >> np.uint64(30))) * _B
        x = (x ^ (x >> np.uint64(27))) * _C
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    def __init__(self, words: np.ndarray, starts: np.ndarray):
        self.words, self.starts = words, starts
        self.before = np.cumsum(np.bitwise_count(words).astype(np.int64)) - np.bitwise_count(words)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """keys: distinct uint64."""
        words, starts, left = [], [0], keys
        while len(left):
            level = len(words)
            size = -(-2 * len(left) // 64)
            at = mix(left, level) % np.uint64(size * 64)
            hits = np.bincount(at.astype(np.int64), minlength=size * 64)
            alone = hits[at.astype(np.int64)] == 1
            bits = np.zeros(size * 64, np.uint8)
            bits[at[alone].astype(np.int64)] = 1
            words.append(np.packbits(bits, bitorder="little").view(np.uint64))
            starts.append(starts[-1] + size)
            left = left[~alone]
        return cls(np.concatenate(words) if words else np.empty(0, np.uint64), np.array(starts, np.int64))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 if no level has its bit. A foreign key may get some key's slot: compare fingerprints."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level in range(len(self.starts) - 1):
            if not len(left):
                break
            first, size = self.starts[level], self.starts[level + 1] - self.starts[level]
            at = (mix(keys[left], level) % np.uint64(size * 64)).astype(np.int64)
            word = self.words[first + at // 64]
            bit = (at % 64).astype(np.uint64)
            on = (word >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(word[on] & ((np.uint64(1) << bit[on]) - np.uint64(1)))
            out[left[on]] = self.before[first + at[on] // 64] + below
            left = left[~on]
        return out

    def dump(self) -> bytes:
        b = io.BytesIO()
        np.savez(b, words=self.words, starts=self.starts)
        return b.getvalue()

    @classmethod
    def load(cls, data: bytes) -> PerfectHash:
        z = np.load(io.BytesIO(data))
        return cls(z["words"], z["starts"])
