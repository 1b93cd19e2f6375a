"""Vectorised 64-bit hashes of the words of many texts."""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE, MIX1, MIX2 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser: spreads every bit over the whole word."""
    x = (x ^ (x >> U(30))) * MIX1
    x = (x ^ (x >> U(27))) * MIX2
    return x ^ (x >> U(31))


class WordHasher:
    """Hashes all words of a slice at once: prefix sums of a polynomial over the bytes, modulo 2^64. A-Z count as
    a-z."""

    def __init__(self):
        self.power = self.inverse = np.ones(0, U)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            back = U(pow(int(BASE), -1, 1 << 64))
            self.power = np.concatenate([np.ones(1, U), np.cumprod(np.full(n, BASE))])
            self.inverse = np.concatenate([np.ones(1, U), np.cumprod(np.full(n, back))])

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words of all texts in order, and words per text."""
        bodies = [t.encode().lower() + b"\n" for t in texts]
        raw = np.frombuffer(b"".join(bodies), np.uint8)
        self._grow(len(raw))
        blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
        before = np.concatenate([[True], blank[:-1]])
        start, stop = np.flatnonzero(~blank & before), np.flatnonzero(blank & ~before)
        sums = np.concatenate([np.zeros(1, U), np.cumsum((raw.astype(U) + U(1)) * self.power[:len(raw)])])
        words = mix((sums[stop] - sums[start]) * self.inverse[start] + (stop - start).astype(U) * MIX2)
        owner = np.searchsorted(np.cumsum([len(b) for b in bodies]), start, side="right")
        return words, np.bincount(owner, minlength=len(texts))
