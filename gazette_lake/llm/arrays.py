"""Text columns of Arrow batches as numpy arrays: slices, runs, hashes.

A slice holds some 128 KB of text, whole rows only, so that the arrays made from it stay in
a processor's cache however many rows a batch has.  One very long text is a slice of its own.
"""

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 17

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows, and where each row starts (one more entry than rows); null is empty."""
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, wide)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in pieces of about ``size`` bytes of text, at least one row each."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end
        release()


def release() -> None:
    """Give back what both allocators hold without using it.  Workers live on between tasks, side by side with others."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):  # the second trims the memory numpy uses, too
        pool.release_unused()


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, which end at row limits too."""
    limit = np.zeros(len(mask) + 1, bool)
    limit[offsets] = True
    begin, end = mask.copy(), mask.copy()
    begin[1:] &= limit[1:-1] | ~mask[:-1]
    end[:-1] &= limit[1:-1] | ~mask[1:]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def mix(value: np.ndarray) -> np.ndarray:
    """Scatter the bits of unsigned 64-bit numbers."""
    value = value ^ (value >> np.uint64(32))
    value *= _MIX
    value ^= value >> np.uint64(29)
    value *= _BASE
    value ^= value >> np.uint64(32)
    return value


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as needed so far."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def reach(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << (n - 1).bit_length()
            up, down = np.full(size, _BASE), np.full(size, _INVERSE)
            up[0] = down[0] = 1
            cls.up, cls.down = np.cumprod(up), np.cumprod(down)
        return cls.up, cls.down


LONG = 64  # items; longer ranges are hashed by their bytes, too


class RangeHash:
    """Hashes of ranges of a sequence, each in constant time.  Equal ranges have equal hashes.

    Sums of powers alone would give some long ranges of very regular order the same hash, whatever
    the base, so a longer range than ``LONG`` adds a digest of its own.
    """

    def __init__(self, items: np.ndarray):
        self.items = items
        up, self.down = _Powers.reach(len(items) + 1)
        terms = items.astype(np.uint64)
        terms += np.uint64(1)
        terms *= _MIX
        terms ^= terms >> np.uint64(31)
        terms *= up[:len(items)]
        self.sums = np.zeros(len(items) + 1, np.uint64)
        np.cumsum(terms, out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        value = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        value += (ends - starts).astype(np.uint64)
        long = np.flatnonzero(ends - starts > LONG)
        if len(long):
            raw, size = memoryview(np.ascontiguousarray(self.items)).cast("B"), self.items.itemsize
            value[long] ^= np.fromiter((
                int.from_bytes(blake2b(raw[a * size:b * size], digest_size=8).digest(), "little")
                for a, b in zip(starts[long].tolist(), ends[long].tolist())), np.uint64, len(long))
        return mix(value)


def hash_ranges(items: np.ndarray, starts: np.ndarray, ends: np.ndarray, at_once: int = SLICE_BYTES) -> np.ndarray:
    """Hashes of ascending, disjoint ranges as ``RangeHash`` gives them, from some ``at_once`` items at a time."""
    value, low = np.empty(len(starts), np.uint64), 0
    while low < len(starts):
        at = starts[low]
        high = max(low + 1, int(np.searchsorted(ends, at + at_once, "right")))
        value[low:high] = RangeHash(items[at:ends[high - 1]])(starts[low:high] - at, ends[low:high] - at)
        low = high
    return value


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words between white space (0x20, 0x09-0x0D), and each row's first word."""
    starts, ends = runs(~_SPACE[data], offsets)
    return starts, ends, np.searchsorted(starts, offsets)


def row_of(first: np.ndarray) -> np.ndarray:
    """The row of each item, given each row's first item (one more entry than rows)."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def sum_rows(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums by row; a row without items has 0."""
    sums = np.zeros(len(values) + 1, values.dtype if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]
