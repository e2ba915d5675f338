"""Words of many texts at once, as numpy arrays over the Arrow buffer of the texts.

The words and their hashes come from a few passes over the bytes, with no
Python step per word. Texts are taken in slices of about SLICE_BYTES, so memory
follows the slice and the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2_000_000
WORDS_AT_ONCE = 1 << 15
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1
_SEQUENCE_BASE = 0xD6E8FEB86659FD93 | 1
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to the 0, 1, ..., modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def range_hashes(values: np.ndarray, start: np.ndarray, stop: np.ndarray, base: int) -> np.ndarray:
    """Hashes of values[start:stop], by differences of one running sum."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(base, n), out=sums[1:])
    inverse = pow(base, -1, 1 << 64)
    found = (sums[stop] - sums[start]) * powers(inverse, n + 1)[start]
    return mixed(found + (stop - start).astype(np.uint64))


class Words:
    """Words of a slice: byte ranges, the document of each, and 64-bit hashes."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = pc.fill_null(texts, "")
        wide = pa.types.is_large_string(texts.type)
        _, offsets, data = texts.buffers()
        kind = np.int64 if wide else np.int32
        bounds = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1]
        bounds = bounds.astype(np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        raw = raw[bounds[0] : bounds[-1]]
        self.data = LOWER[raw] if lower else raw
        self.bounds = bounds - bounds[0]
        self.documents = len(texts)
        inside = ~SEPARATOR[raw]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        cuts = self.bounds[:-1][self.bounds[:-1] < len(raw)]
        begins[cuts] = inside[cuts]
        cuts = self.bounds[1:][self.bounds[1:] > 0] - 1
        ends[cuts] = inside[cuts]
        self.start = np.flatnonzero(begins)
        self.stop = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, self.bounds)
        self.count = np.diff(self.first)
        self.document = np.repeat(np.arange(self.documents), self.count)

    def hashes(self) -> np.ndarray:
        """Hashes of the words, a stretch at a time: sums over bytes take much more room than words."""
        found = np.empty(len(self.start), np.uint64)
        for a in range(0, len(found), WORDS_AT_ONCE):
            start, stop = self.start[a : a + WORDS_AT_ONCE], self.stop[a : a + WORDS_AT_ONCE]
            values = _BYTE_VALUE[self.data[start[0] : stop[-1]]]
            found[a : a + len(start)] = range_hashes(values, start - start[0], stop - start[0], _BASE)
        return found


def sequence_hashes(hashes: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """Hashes of ``length`` consecutive words from each start."""
    return range_hashes(hashes, start, start + length, _SEQUENCE_BASE)


def positions(count: np.ndarray, first: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... count[i] times, one after another."""
    ahead = np.cumsum(count) - count
    return np.repeat(first - ahead, count) + np.arange(count.sum())


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the texts of one take about ``most`` bytes, or are a single text.

    Arrow's unused memory goes back at the end, since workers outlive their task.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
            yield batch.slice(at, to - at)
            at = to
    pa.default_memory_pool().release_unused()
