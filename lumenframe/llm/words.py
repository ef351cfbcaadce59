"""Words of UTF-8 texts as arrays: where they start and end, and a 64-bit hash of each.

A word is a run of bytes other than space and the five control characters
0x09-0x0D, which is what ``bytes.split()`` cuts at. All arithmetic is modulo
2^64, as unsigned numpy integers do it.
"""

from __future__ import annotations

import numpy as np

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of text that are hashed at a time; bounds the eight-byte arrays made of them.
SEGMENT = 2_000_000

_MASK = (1 << 64) - 1


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: int):
        self.base = base
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (self._table(b, size) for b in (self.base, pow(self.base, -1, 1 << 64)))
        return self.up[:n], self.down[:n]

    @staticmethod
    def _table(base: int, n: int) -> np.ndarray:
        steps = np.full(n, base & _MASK, dtype=np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)


#: Odd multipliers for the hashes; any odd number with well-spread bits would do.
BYTES = Powers(0x9E3779B97F4A7C15)
TOKENS = Powers(0xC2B2AE3D27D4EB4F)
TOKENS_2 = Powers(0xD6E8FEB86659FD93)


def forget_tables() -> None:
    """Drop the powers that a large text made; they are made anew when one comes again."""
    for powers in (BYTES, TOKENS, TOKENS_2):
        powers.up = powers.down = np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 (one-to-one)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def sums(values: np.ndarray, powers: Powers, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of each ``values[start:end]``, the same wherever the run stands."""
    up, down = powers.upto(len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[end] - total[start]) * down[start])


class Words:
    """Words of many texts: ``start`` and ``end`` in the joined bytes, ``text`` (its number), ``hash``."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.n_texts = len(texts)
        data = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
        if lower:
            data = LOWER[data]
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.at = np.concatenate([[0], np.cumsum(sizes + 1)])  # where each text starts
        space = SPACE[data] if len(data) else np.ones(0, dtype=bool)
        edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
        self.start, self.end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self.text = np.searchsorted(self.at, self.start, side="right") - 1
        self.counts = np.bincount(self.text, minlength=len(texts)).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])  # number of each text's first word
        self.hash = self._hashes(data)

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.start), dtype=np.uint64)
        at = 0
        while at < len(out):  # whole words, as many as a segment holds, or one that is longer
            stop = max(at + 1, int(np.searchsorted(self.end, self.start[at] + SEGMENT, side="right")))
            low = self.start[at]
            part = data[low : self.end[stop - 1]].astype(np.uint64) + np.uint64(1)
            out[at:stop] = sums(part, BYTES, self.start[at:stop] - low, self.end[at:stop] - low)
            at = stop
        return out

    def windows(self, size: int, powers: Powers = TOKENS) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words that start a window of ``size`` words of one text, and the windows' hashes."""
        n = len(self.hash)
        if n < size:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        i = np.flatnonzero(self.text[: n - size + 1] == self.text[size - 1 :])
        return i, sums(self.hash, powers, i, i + size)
