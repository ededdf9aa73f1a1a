"""Vectorised rolling hashes over bytes or word ids, for tasks that hold one document at a time."""

from __future__ import annotations

import numpy as np

U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
SECOND_BASE = 0xC2B2AE3D27D4EB4D  # for a second, independent hash


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the word (two xor-multiply rounds; a bijection)."""
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


_LETTER = mix(np.arange(1, 257, dtype=U) * U(0xA24BAED4963EE407))
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of a base, kept between documents."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 0 if have is None else 2 * len(have), 1 << 12), base, dtype=U)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:n]


class Rolling:
    """Hashes of any substrings of one sequence, from prefix sums modulo 2**64."""

    def __init__(self, symbols: np.ndarray, base: int = _BASE):
        """``symbols``: uint8 bytes, or uint64 values that are already well spread."""
        letters = _LETTER[symbols] if symbols.dtype == np.uint8 else symbols
        self.n, self.inverse = len(symbols), pow(base, -1, 1 << 64)
        self.sums = np.zeros(self.n + 1, dtype=U)
        np.cumsum(letters * _power(base, self.n), out=self.sums[1:])

    def all_of(self, length: int) -> np.ndarray:
        """The hash of every substring of ``length``."""
        count = self.n - length + 1
        if count <= 0:
            return np.zeros(0, dtype=U)
        return mix((self.sums[length:] - self.sums[:count]) * _power(self.inverse, count))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The hashes of ``[start, end)``; lengths take part."""
        raw = (self.sums[end] - self.sums[start]) * _power(self.inverse, self.n + 1)[start]
        return mix(raw + (end - start).astype(U) * U(0xC2B2AE3D27D4EB4F))


def words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes other than space and 0x09 to 0x0D."""
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = (raw != 32) & ((raw < 9) | (raw > 13))
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A 64-bit hash for every word, with its start and end."""
    starts, ends = words(data)
    if not len(starts):
        return np.zeros(0, dtype=U), starts, ends
    return Rolling(np.frombuffer(data, dtype=np.uint8)).of(starts, ends), starts, ends


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost smallest value in each window, by doubling.

    The upper 33 bits of a value decide; a tie goes to the smaller position.
    """
    best = (values & U(0xFFFFFFFF80000000)) | np.arange(len(values), dtype=U)
    span = 1
    while 2 * span <= width:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    if span < width:
        rest = width - span
        best = np.minimum(best[:-rest], best[rest:])
    return (best & U(0x7FFFFFFF)).astype(np.int64)
