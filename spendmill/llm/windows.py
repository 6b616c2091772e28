"""Hashes of all windows of a sequence, and the anchors that stand for them.

An anchor is a short gram chosen by content alone: every window of `window` units owns the gram of `gram` units inside it
whose hash is smallest (the leftmost of equals). Equal windows own equal grams at equal places, wherever they stand, so a
window can only repeat if its anchor does. Neighbouring windows mostly share their anchor.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np

U = np.uint64
CHUNK_BITS = 20
CHUNK = 1 << CHUNK_BITS
# Odd numbers, so that they have inverses modulo 2^64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@cache
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, U)
    out[0] = 1
    return np.cumprod(out)


@cache
def _byte_values(which: int) -> np.ndarray:
    return np.random.default_rng(20_240_229 + which).integers(1, 2**64 - 1, 256, dtype=U)


def mixed(values: np.ndarray) -> np.ndarray:
    """Finishing step of a 64-bit hash: spreads high bits to low ones."""
    values = (values ^ (values >> U(32))) * U(0xD6E8FEB86659FD93)
    values = (values ^ (values >> U(29))) * U(0xD6E8FEB86659FD93)
    return values ^ (values >> U(32))


class Prefix:
    """Polynomial hashes modulo 2^64 of any stretch of a sequence, from one running sum."""

    def __init__(self, units: np.ndarray, which: int = 0):
        base = BASES[which]
        size = 1 << max(len(units).bit_length(), CHUNK_BITS)
        self.down = _powers(pow(base, -1, 1 << 64), size)
        self.sums = np.concatenate([np.zeros(1, U), np.cumsum(units * _powers(base, size)[: len(units)])])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:n]) * self.down[:n]) if n > 0 else np.zeros(0, U)


def byte_units(text: bytes, which: int = 0) -> np.ndarray:
    return _byte_values(which)[np.frombuffer(text, np.uint8)]


def word_spans(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words between ASCII white space."""
    inside = np.concatenate([[False], ~_SPACE[np.frombuffer(text, np.uint8)], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def word_units(text: bytes, which: int = 0) -> np.ndarray:
    starts, ends = word_spans(text)
    # The length keeps words apart that differ in a run of the same value only.
    return Prefix(byte_units(text, which), which).of(starts, ends) + (ends - starts).astype(U)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbours, by doubling."""
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def owners(units: np.ndarray, gram: int, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per stretch of a sequence: anchor places, their hashes, and the first and last window start that each owns.

    A long sequence is taken in overlapping stretches; an anchor whose windows lie in two of them appears twice, with the
    windows divided.
    """
    width = window - gram + 1
    step = CHUNK - window
    for low in range(0, max(len(units) - window + 1, 0), step):
        part = units[low : low + step + window - 1]
        hashes = Prefix(part).grams(gram)
        # The place in the low bits: the minimum tells where it stands, and equals go to the left.
        keys = (hashes & ~U(CHUNK - 1)) | np.arange(len(hashes), dtype=U)
        place = (sliding_min(keys, width) & U(CHUNK - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.append(first[1:], len(place)) - 1
        own = place[first]
        yield own + low, hashes[own], first + low, last + low
