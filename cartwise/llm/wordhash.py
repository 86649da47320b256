"""Vectorised word, shingle and window hashes of one text (numpy, inside tasks).

Words are ``[^\\x20\\x09-\\x0D]+``: exactly what ``bytes.split()`` leaves of the
UTF-8 text.  A word's hash is a polynomial over its bytes, taken from a
prefix sum over the whole text, so no Python loop runs per word; sequences
of words are hashed the same way one level up.  All arithmetic wraps at
2**64 and ends in a bit mixer.
"""

from __future__ import annotations

import numpy as np

_P = 0x9E3779B97F4A7C15  # odd, hence invertible modulo 2**64
_M = (1 << 64) - 1
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift, multiply)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Powers:
    """Powers of an odd base and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inv = base & _M, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inv, k, 1 << 64))])
        return self.up, self.down


class WordHasher:
    """Hashes for one ``seed``; keep one instance per task."""

    def __init__(self, seed: int = 1):
        table = np.arange(256, dtype=np.uint64) * np.uint64(_P) + np.uint64((seed * 0xD1B54A32D192ED03) & _M)
        self.table = mix(table) | np.uint64(1)
        self.chars = Powers(((seed * 0xA0761D6478BD642F) & _M) | 1)
        self.words = Powers(((seed * 0xE7037ED1A0B428DB) & _M) | 1)
        self.other = Powers(((seed * 0x8EBC6AF09C88C6E3) & _M) | 1)

    def bounds(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Start and end byte offsets of the words of ``raw``."""
        b = np.frombuffer(raw, np.uint8)
        edge = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[b], [True]]).astype(np.int8)))
        return edge[::2], edge[1::2]

    def word_hashes(self, raw: bytes, bounds=None) -> np.ndarray:
        start, end = self.bounds(raw) if bounds is None else bounds
        if not len(start):
            return np.zeros(0, np.uint64)
        b = np.frombuffer(raw, np.uint8)
        up, down = self.chars.get(len(b))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.table[b] * up[:len(b)], dtype=np.uint64)])
        return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))

    def sums(self, hashes: np.ndarray, powers: Powers) -> np.ndarray:
        up, _ = powers.get(len(hashes))
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[:len(hashes)], dtype=np.uint64)])

    def spans(self, hashes: np.ndarray, start: np.ndarray, end: np.ndarray, second: bool = False) -> np.ndarray:
        """Hash of the words ``start .. end - 1``, for arrays of both; ``second`` takes another base."""
        powers = self.other if second else self.words
        total = self.sums(hashes, powers)
        return mix((total[end] - total[start]) * powers.get(len(hashes))[1][start] + (end - start).astype(np.uint64))

    def runs(self, hashes: np.ndarray, k: int, second: bool = False) -> np.ndarray:
        """Hash of every run of ``k`` consecutive words (none if fewer)."""
        start = np.arange(max(0, len(hashes) - k + 1))
        return self.spans(hashes, start, start + k, second) if len(start) else np.zeros(0, np.uint64)


def sliding(x: np.ndarray, w: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over every window of ``w`` values."""
    span, out = 1, x
    while span * 2 <= w:
        out = pick(out[:-span], out[span:])
        span *= 2
    rest = w - span
    return pick(out[:-rest], out[rest:]) if rest else out
