"""Distinct word shingles of texts as 64-bit numbers, computed for many texts at once."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from areaflow.llm import texts

WORDS = 5
_PIECE = 1 << 20

_STEP = np.uint64(0xA24BAED4963EE407)
#: Bytes of a word that are hashed eight at a time, all words at once; longer words are hashed one by one.
_SHORT = 256
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32  # A-Z count as a-z
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_GAP = np.zeros(256, bool)
_GAP[[32, *range(9, 14)]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashed(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each lower-cased word; words of up to eight bytes never collide among those of their length."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = _LOWER[data]
    blocks = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from every place on
    hashes = _mixed(sizes.astype(np.uint64) * _STEP)
    some = np.flatnonzero(sizes <= _SHORT)
    done = 0
    while len(some):
        block = blocks[starts[some] + done] & _MASKS[np.minimum(sizes[some] - done, 8)]
        hashes[some] = _mixed((hashes[some] ^ block) + _STEP)
        done += 8
        some = some[sizes[some] > done]
    for k in np.flatnonzero(sizes > _SHORT).tolist():
        word = padded[starts[k] : starts[k] + sizes[k]]
        hashes[k] = np.frombuffer(hashlib.blake2b(word, digest_size=8).digest(), np.uint64)[0]
    return hashes


class Shingler:
    """Made once in each task."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self.factors = _mixed(np.arange(11, 11 + words, dtype=np.uint64)) | np.uint64(1)

    def word_hashes(self, data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hash of every word, and the n + 1 places in it where each text's words begin."""
        gap = _GAP[data]
        inside = np.flatnonzero(~gap)
        if not len(inside):
            return np.zeros(0, np.uint64), np.zeros(len(begins), np.int64)
        cut = np.zeros(len(data) + 1, bool)  # a word may not go on from one text to the next
        cut[begins] = True
        first = np.r_[True, np.diff(inside) > 1] | cut[inside]
        starts = inside[first]
        lasts = inside[np.r_[np.flatnonzero(first)[1:] - 1, len(inside) - 1]]
        hashes = _hashed(data, starts, lasts - starts + 1)
        return hashes, np.searchsorted(starts, begins)

    def sets(self, column: pa.Array) -> Iterator[np.ndarray]:
        """For every text its distinct shingles, ascending."""
        data, begins = texts.raw_bytes(column)
        hashes, at = self.word_hashes(data, begins)
        k = self.words
        rolled = np.zeros(0, np.uint64)
        if len(hashes) >= k:
            n = len(hashes) - k + 1
            rolled = hashes[:n] * self.factors[0]
            for j in range(1, k):
                rolled = rolled + hashes[j : j + n] * self.factors[j]
            rolled = _mixed(rolled)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if b - a >= k:
                own = np.sort(rolled[a : b - k + 1])
                yield own[np.r_[True, own[1:] != own[:-1]]]
            elif b > a:
                mixed = (hashes[a:b] * self.factors[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                yield _mixed(np.array([mixed ^ np.uint64(0x5851F42D4C957F2D)], np.uint64))
            else:
                yield np.zeros(0, np.uint64)

    def pieces(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray]]]:
        """Ids and sets, piece by piece."""
        for piece in texts.pieces(batches, "text", _PIECE):
            yield piece.column("doc_id").to_pylist(), list(self.sets(piece.column("text")))


def signature(own: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    digest = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
    return tuple(np.frombuffer(digest, np.int64).tolist())


def pack(numbers: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, so that equal high bytes lie together and compress."""
    return numbers.view(np.uint8).reshape(len(numbers), -1).T.tobytes()


def unpack(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()
