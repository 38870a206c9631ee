"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column.

A word is a maximal run of bytes other than space and 0x09-0x0D, lower-cased in A-Z only. Every word
gets a 64-bit hash: a polynomial over randomly drawn values per byte, computed for all words of a slice
from one running sum, then mixed. No Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE_BYTES = 1 << 19

_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        have = _powers[base] = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def mix_int(x: int) -> int:
    return int(mix(np.array([x & 0xFFFFFFFFFFFFFFFF], np.uint64))[0])


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts of about ``limit`` bytes.

    A null text has no bytes. A text longer than the limit is a run of its own.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not pa.types.is_large_string(texts.type) and not pa.types.is_string(texts.type):
        texts = texts.cast(pa.string())
    n = len(texts)
    if not n:
        return
    wide = pa.types.is_large_string(texts.type)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    if texts.null_count:  # bytes below a null are not part of any text
        texts = texts.fill_null("")
        buffers = texts.buffers()
        offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
        data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


class Words:
    """Word starts, ends and hashes of a run of texts; ``first[d]:first[d + 1]`` are text d's words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.raw, self.offsets = data, offsets
        self.low = low = LOWER[data]
        solid = np.empty(len(low) + 1, bool)
        solid[:-1] = ~SPACE[low]
        solid[-1] = False
        before = np.empty(len(low) + 1, bool)
        before[0] = False
        before[1:] = solid[:-1]
        at = offsets[1:-1]
        cut = np.zeros(len(low) + 1, bool)
        cut[at] = True  # a text's first byte begins a word whatever stands before it
        self.starts = np.flatnonzero(solid & (~before | cut))
        self.ends = np.flatnonzero(before & (~solid | cut))
        self.first = np.searchsorted(self.starts, offsets)
        self._sums: np.ndarray | None = None

    def _running(self) -> np.ndarray:
        if self._sums is None:
            n = len(self.low)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(BYTE_VALUE[self.low] * powers(BASE, n), out=sums[1:])
            self._sums = sums
        return self._sums

    def hashes(self, starts: np.ndarray | None = None, ends: np.ndarray | None = None) -> np.ndarray:
        starts = self.starts if starts is None else starts
        ends = self.ends if ends is None else ends
        sums = self._running()
        h = (sums[ends] - sums[starts]) * powers(INVERSE, len(self.low) + 1)[starts]
        return mix(h + (ends - starts).astype(np.uint64) * U(0xD6E8FEB86659FD93))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def chain(acc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Take one more word into a running hash of a sequence; the order counts."""
    return mix(acc * U(0xC2B2AE3D27D4EB4F) + h)


def shingle_sets(words: Words, n: int) -> Iterator[np.ndarray]:
    """Per text, the sorted distinct 64-bit hashes of its n-word shingles.

    A text of fewer words has its whole sequence as its one shingle; one without words has none.
    """
    h, first = words.hashes(), words.first
    total = len(h)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    if total >= n:
        acc = np.full(total - n + 1, n, np.uint64)
        for j in range(n):
            acc = chain(acc, h[j : total - n + 1 + j])
        keep = doc[: total - n + 1] == doc[n - 1 :]
        acc, of = acc[keep], doc[: total - n + 1][keep]
    else:
        acc, of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    bounds = np.searchsorted(of, np.arange(len(first)))
    for d in range(len(first) - 1):
        m = int(first[d + 1] - first[d])
        if m >= n:
            s = np.sort(acc[bounds[d] : bounds[d + 1]])
            yield s[np.concatenate(([True], s[1:] != s[:-1]))]
        elif m:
            one = np.array([m], np.uint64)
            for j in range(m):
                one = chain(one, h[first[d] + j : first[d] + j + 1])
            yield one
        else:
            yield np.zeros(0, np.uint64)
