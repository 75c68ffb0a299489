"""Minimal perfect hash over 128-bit keys, in numpy.

Levels of bit arrays: at each level every remaining key hashes to one bit;
keys alone on their bit stay there, the others go to the next level. A key's
index is the rank of its bit over all levels, so n keys use exactly the
indexes 0..n-1 and about 3 bits each; keys themselves are not stored.
"""

from __future__ import annotations

import numpy as np

GAMMA = 2.0
_MAX_LEVELS = 200


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _slot(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return (mix(mix(h1 + seed) ^ h2) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Built from distinct (h1, h2) pairs; ``index`` gives -1 for keys that
    reach no set bit (a key outside the set may also get some index)."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, base = [], 0
        for bits in levels:
            ranks = np.cumsum(bits, dtype=np.int64) - bits + base
            self.ranks.append(ranks)
            base += int(bits.sum())
        self.size = base

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        h1, h2 = h1.astype(np.uint64), h2.astype(np.uint64)
        levels = []
        while len(h1):
            if len(levels) == _MAX_LEVELS:
                raise ValueError("keys of a perfect hash must be distinct")
            size = max(64, int(GAMMA * len(h1)))
            at = _slot(h1, h2, len(levels), size)
            bits = (np.bincount(at, minlength=size) == 1)
            levels.append(bits)
            rest = ~bits[at]
            h1, h2 = h1[rest], h2[rest]
        return cls(levels)

    def index(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        h1, h2 = h1.astype(np.uint64), h2.astype(np.uint64)
        out = np.full(len(h1), -1, np.int64)
        left = np.arange(len(h1))
        for level, bits in enumerate(self.levels):
            if not len(left):
                break
            at = _slot(h1[left], h2[left], level, len(bits))
            hit = bits[at]
            out[left[hit]] = self.ranks[level][at[hit]]
            left = left[~hit]
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.levels), *map(len, self.levels)], np.int64).tobytes()
        return head + b"".join(np.packbits(b).tobytes() for b in self.levels)

    @classmethod
    def from_bytes(cls, blob: bytes) -> PerfectHash:
        n = int(np.frombuffer(blob, np.int64, 1)[0])
        sizes = np.frombuffer(blob, np.int64, n, 8)
        levels, at = [], 8 * (n + 1)
        for size in sizes.tolist():
            width = -(-size // 8)
            packed = np.frombuffer(blob, np.uint8, width, at)
            levels.append(np.unpackbits(packed, count=size).astype(bool))
            at += width
        return cls(levels)


class LineArrays:
    """One shard: perfect hash, 32-bit fingerprints, document counts and the
    smallest document of each key. With ``whole`` keys the full 128 bits are
    held too and compared: for a shard that is probed with keys of others."""

    def __init__(self, phf: PerfectHash, prints: np.ndarray, counts: np.ndarray, first: np.ndarray,
                 keys: np.ndarray | None = None):
        self.phf, self.prints, self.counts, self.first, self.keys = phf, prints, counts, first, keys

    @classmethod
    def build(cls, h1, h2, counts, first, whole: bool = False) -> LineArrays:
        phf = PerfectHash.build(h1, h2)
        at = phf.index(h1, h2)
        prints, n, lowest = (np.empty(len(h1), t) for t in (np.uint32, np.int64, np.int64))
        prints[at], n[at], lowest[at] = fingerprint(h1, h2), counts, first
        if not whole:
            return cls(phf, prints, n, lowest)
        keys = np.empty((len(h1), 2), np.int64)
        keys[at, 0], keys[at, 1] = h1, h2
        return cls(phf, prints, n, lowest, keys)

    def probe(self, h1, h2) -> tuple[np.ndarray, np.ndarray]:
        """(document count, smallest document) of each key; count 0: not held."""
        if not len(self.prints):
            return np.zeros(len(h1), np.int64), np.zeros(len(h1), np.int64)
        at = self.phf.index(h1, h2)
        known = (at >= 0) & (self.prints[at] == fingerprint(h1, h2))
        if self.keys is not None:
            known &= (self.keys[at, 0] == h1) & (self.keys[at, 1] == h2)
        return np.where(known, self.counts[at], 0), self.first[at]

    def columns(self) -> dict[str, bytes]:
        return {"phf": self.phf.to_bytes(), "prints": self.prints.tobytes(),
                "counts": self.counts.tobytes(), "first": self.first.tobytes()}

    @classmethod
    def from_columns(cls, phf: bytes, prints: bytes, counts: bytes, first: bytes) -> LineArrays:
        return cls(PerfectHash.from_bytes(phf), np.frombuffer(prints, np.uint32),
                   np.frombuffer(counts, np.int64), np.frombuffer(first, np.int64))


def fingerprint(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return (mix(h1.astype(np.uint64) + mix(h2.astype(np.uint64))) >> np.uint64(32)).astype(np.uint32)
