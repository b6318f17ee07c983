"""Words and hashes of whole texts, a batch at a time, in numpy.

A batch of texts is one array of UTF-8 bytes and the places where the texts
begin. All functions work on such arrays, so no Python runs per word or row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text worked on at once. Longer texts are a piece of their own.
SLICE_BYTES = 2 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the SplitMix64 finaliser)."""
    values = np.asarray(values, np.uint64)
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags, true outside the inclusive ranges."""
    table = np.ones(256, bool)
    for low, high in ranges:
        table[low : high + 1] = False
    return table


# Bytes from 0x80 up belong to characters beyond ASCII, all of them word characters.
SPACED = byte_class((0x20, 0x20), (0x09, 0x0D))
ALPHANUMERIC = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
ALPHANUMERIC[ord("A") : ord("Z") + 1] = True

FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32
_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _STEP) | np.uint64(1)
_FOLDED_CODES = _CODES[FOLD]


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def powers(base: int) -> np.ndarray:
        out = np.full(size, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return powers(_BASE), powers(pow(_BASE, -1, 1 << 64))


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, at least so many."""
    up, down = _powers(max(SLICE_BYTES + 1, 1 << (size - 1).bit_length() if size > 1 else 2))
    return up[:size], down[:size]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their bounds (one more than texts); null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    size = len(column)
    _, bounds, data = column.buffers()
    if size == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(bounds, np.int64)[column.offset : column.offset + size + 1]
    if offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(size + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about SLICE_BYTES of text, a row at least in each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield batch.slice(start, stop - start)
        start = stop


class Words:
    """Words of the texts of a batch: byte bounds, and the text each is in."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray):
        self.data, self.offsets = data, offsets
        inside = kind[data]
        edge = np.ones(len(data) + 1, bool)
        edge[1:-1] = inside[1:] != inside[:-1]
        edge[offsets] = True
        self.start = np.flatnonzero(edge[:-1] & inside)
        self.end = np.flatnonzero(edge[1:] & inside) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, fold: bool = True) -> np.ndarray:
        """64-bit hashes of the words, A-Z as a-z if ``fold``."""
        up, down = powers(len(self.data) + 1)
        sums = np.empty(len(self.data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum((_FOLDED_CODES if fold else _CODES)[self.data] * down[:-1], out=sums[1:])
        return mix((sums[self.end] - sums[self.start]) * up[self.end - 1])


def sequence_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of so many neighbours; each run is named by its first."""
    if length == 1:
        return hashes
    count = len(hashes) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for i in range(length):
        out = out * np.uint64(_BASE) + hashes[i : i + count]
    return mix(out)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All whole numbers of the ranges that begin at ``starts``, one range after another."""
    counts = np.asarray(counts, np.int64)
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    jumps = np.repeat(np.asarray(starts, np.int64) - (np.cumsum(counts) - counts), counts)
    return jumps + np.arange(total)
