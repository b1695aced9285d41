"""Hashes of all words of many texts at once, in numpy.

A word's hash is the polynomial sum of T[byte] R^i over its bytes, for a table T of random 64-bit
numbers and an odd random R, taken from running sums over the whole buffer (so no step per word),
then mixed. Two lanes with their own T and R give 128 bits.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_random = np.random.Generator(np.random.PCG64(20240501))
_TABLE = _random.integers(1, 2**64 - 1, (2, 256), dtype=np.uint64)
_BASE = [int(x) | 1 for x in _random.integers(1, 2**64 - 1, 2, dtype=np.uint64)]
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
STRETCH = 1 << 19
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = x ^ (x >> U(32))
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    return x


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of a sequence from those of two parts (order counts)."""
    return mix(a * U(0x9E3779B97F4A7C15) + b * U(0xC2B2AE3D27D4EB4F) + U(0x165667B19E3779F9))


def _power(lane: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get(lane)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        out = []
        for base in (_BASE[lane], pow(_BASE[lane], -1, 2**64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = _powers[lane] = (out[0], out[1])
    return have[0][:n], have[1][:n]


class Words:
    """The words (runs of bytes other than ASCII white space) of texts joined by line feeds."""

    def __init__(self, texts: list[bytes]):
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.buffer = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        inside = np.concatenate([[False], ~_WHITE[self.buffer], [False]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        self.begin, self.end = edge[::2], edge[1::2]
        offsets = np.cumsum(self.sizes + 1) - (self.sizes + 1)
        #: words before each text, and in all
        self.first = np.concatenate([np.searchsorted(self.begin, offsets), [len(self.begin)]])
        self.count = np.diff(self.first)

    def hashes(self, lane: int = 0) -> np.ndarray:
        # Stretches of a bounded length (or one longer word), so that the powers stay small.
        out = np.empty(len(self.begin), np.uint64)
        k = 0
        while k < len(out):
            start = self.begin[k]
            stop = max(k + 1, int(np.searchsorted(self.end, start + STRETCH, side="right")))
            part = self.buffer[start:self.end[stop - 1]]
            power, inverse = _power(lane, len(part))
            sums = np.empty(len(part) + 1, np.uint64)
            sums[0] = 0
            np.cumsum(_TABLE[lane][part] * power, out=sums[1:])
            begin = self.begin[k:stop] - start
            out[k:stop] = mix((sums[self.end[k:stop] - start] - sums[begin]) * inverse[begin])
            k = stop
        return out

    def left(self) -> np.ndarray:
        """Words from each word to its text's end, itself included."""
        return np.repeat(self.first[1:], self.count) - np.arange(len(self.begin))


def grams(one: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all sequences of ``length`` words, by doubling (the last doubling may overlap)."""
    have, size = one, 1
    while size < length:
        step = min(size, length - size)
        have = pair(have[:len(have) - step], have[step:]) if len(have) > step else have[:0]
        size += step
    return have
