"""A minimal perfect hash over distinct 128-bit keys, in numpy.

A key tries one place in each of a few bit arrays that shrink from level to
level.  On a level only keys alone at their place set its bit; the others go on to
the next.  The number of bits set before a key's own is its index, so ``n`` keys get
the indexes ``0`` to ``n - 1``.  Keys left after the last level are listed.
"""

from __future__ import annotations

import numpy as np

#: Places a key has to choose from on a level.
ROOM = 2
LEVELS = 32

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _places(low: np.ndarray, high: np.ndarray, level: int, size: int) -> np.ndarray:
    """Where keys fall on a level of ``size`` bits."""
    with np.errstate(over="ignore"):
        x = low ^ (high * _STEP + np.uint64(level + 1) * _MIX[1])
        x = (x ^ (x >> np.uint64(30))) * _MIX[0]
        x = (x ^ (x >> np.uint64(27))) * _MIX[1]
        x ^= x >> np.uint64(31)
    return (x % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """``sizes`` of the levels, their ``bits`` one after the other, and ``rest``, keys that found no place."""

    def __init__(self, sizes: list[int], bits: np.ndarray, rest: np.ndarray):
        self.sizes, self.bits, self.rest = sizes, bits, rest
        self.ranks = np.cumsum(bits, dtype=np.int64) - bits

    @classmethod
    def build(cls, low: np.ndarray, high: np.ndarray, levels: int = LEVELS) -> PerfectHash:
        """The hash of distinct keys, each two unsigned 64-bit halves."""
        sizes, bits = [], []
        for level in range(levels):
            if not len(low):
                break
            size = max(8, ROOM * len(low))
            places = _places(low, high, level, size)
            keys_at = np.bincount(places, minlength=size)
            sizes.append(size)
            bits.append(keys_at == 1)
            shared = keys_at[places] > 1
            low, high = low[shared], high[shared]
        rest = np.stack([low, high], axis=1)
        return cls(sizes, np.concatenate(bits) if bits else np.zeros(0, bool), rest)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The index of each key; of a key that was not built in, some index or -1."""
        found = np.full(len(low), -1, np.int64)
        open_ = np.arange(len(low))
        base = 0
        for level, size in enumerate(self.sizes):
            places = base + _places(low[open_], high[open_], level, size)
            hit = self.bits[places]
            found[open_[hit]] = self.ranks[places[hit]]
            open_ = open_[~hit]
            base += size
        placed = int(self.bits.sum())
        for i, (a, b) in enumerate(self.rest):
            found[open_[(low[open_] == a) & (high[open_] == b)]] = placed + i
        return found

    def to_row(self) -> dict:
        return {"sizes": self.sizes, "bits": np.packbits(self.bits).tobytes(), "rest": self.rest.tobytes()}

    @classmethod
    def from_row(cls, sizes: list[int], bits: bytes, rest: bytes) -> PerfectHash:
        flat = np.unpackbits(np.frombuffer(bits, np.uint8), count=sum(sizes)).astype(bool)
        return cls(sizes, flat, np.frombuffer(rest, np.uint64).reshape(-1, 2))
