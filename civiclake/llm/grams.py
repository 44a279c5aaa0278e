"""Hashes of word sequences, a document at a time with NumPy."""

from __future__ import annotations

import numpy as np
import xxhash

_BASE = np.uint64(0x9FB21C651E98DF25)
_INVERSE = np.uint64(pow(0x9FB21C651E98DF25, -1, 1 << 64))
_MIX_A, _MIX_B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; different values stay different."""
    x = (x ^ (x >> _S33)) * _MIX_A
    x = (x ^ (x >> _S33)) * _MIX_B
    return x ^ (x >> _S33)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """Two rows of 64-bit hashes, a column per word."""
    flat = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), "<u8")
    return np.ascontiguousarray(flat.reshape(-1, 2).T)


class Powers:
    """Powers of the base and of its inverse, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < size:
            size = max(size, 2 * len(self.up), 4096)
            for name, factor in (("up", _BASE), ("down", _INVERSE)):
                values = np.full(size, factor, np.uint64)
                values[0] = 1
                setattr(self, name, np.cumprod(values, dtype=np.uint64))
        return self.up, self.down


_powers = Powers()


class Sequence:
    """Hashes of any stretches of one document's words: polynomials modulo 2**64 over word hashes."""

    def __init__(self, hashes: np.ndarray):
        self.size = len(hashes)
        up, self.down = _powers.to(self.size + 1)
        self.sums = np.zeros(self.size + 1, np.uint64)
        np.cumsum(hashes * up[: self.size], out=self.sums[1:])

    def stretch(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hash of the words start..stop-1, the same wherever they stand; lengths count too."""
        value = (self.sums[stop] - self.sums[start]) * self.down[start]
        return mix(value + (stop - start).astype(np.uint64) * _MIX_A)

    def grams(self, length: int) -> np.ndarray:
        """Hashes of all stretches of `length` words."""
        start = np.arange(max(0, self.size - length + 1))
        return self.stretch(start, start + length)


def signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)
