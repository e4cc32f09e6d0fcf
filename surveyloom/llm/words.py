"""Words of whole texts, split and hashed as numpy arrays over Arrow's own buffers."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text worked on at a time; a longer text is worked on alone.
CHUNK_BYTES = 2 << 20

_MUL_1, _MUL_2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
_STEP = U64(0x9E3779B97F4A7C15)
_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [(1 << 64) - 1], dtype=U64)


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags, true within the ranges (both ends included)."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: What words ``[^\x20\x09-\x0D]+`` end at.
BLANKS = byte_set((0x20, 0x20), (0x09, 0x0D))
#: All ASCII but letters; bytes of other letters are kept.
NOT_LETTERS = byte_set((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Mix the bits of 64-bit values so that each depends on all."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= _MUL_1
    x ^= x >> U64(27)
    x *= _MUL_2
    x ^= x >> U64(31)
    return x


@dataclass
class Words:
    """Words of rows ``low`` to ``high`` of a batch; ``first[i]`` is row i's first word."""

    low: int
    high: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word, eight bytes at a step."""
        size = self.ends - self.starts
        out = size.astype(U64) * _STEP + U64(seed)
        if not len(out):
            return out
        eights = np.ndarray((len(self.data) - 7,), "<u8", self.data, 0, (1,))
        at, left, which = self.starts, size, slice(None)
        while True:
            step = eights[at] & _MASKS[np.minimum(left, 8)]
            out[which] = mix((out[which] ^ step) + _STEP)
            more = left > 8
            if not more.any():
                return out
            which = np.flatnonzero(more) if isinstance(which, slice) else which[more]
            at, left = at[more] + 8, left[more] - 8

    def row_of(self) -> np.ndarray:
        """The row (from 0) of each word."""
        return np.repeat(np.arange(self.high - self.low), np.diff(self.first))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], "<i8")[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data, offsets


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches of fewer rows, for work that makes Python objects or large arrays of each."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def split_words(column: pa.Array, ends_at: np.ndarray, fold: np.ndarray | None = None) -> Iterator[Words]:
    """Words of every text in order, in chunks of whole texts."""
    if not len(column):
        return
    data, offsets = text_buffers(column)
    low, n = 0, len(column)
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + CHUNK_BYTES, "right")) - 1
        high = min(max(high, low + 1), n)
        body = data[offsets[low] : offsets[high]]
        at = offsets[low : high + 1] - offsets[low]
        inside = np.zeros(len(body) + 2, dtype=bool)
        np.logical_not(ends_at[body], out=inside[1:-1])
        begins = inside[1:-1] & ~inside[:-2]
        stops = inside[1:-1] & ~inside[2:]
        edges = at[1:-1]
        edges = edges[(edges > 0) & (edges < len(body))]
        begins[edges] |= inside[1:-1][edges]
        stops[edges - 1] |= inside[1:-1][edges - 1]
        starts = np.flatnonzero(begins)
        padded = np.zeros(len(body) + 16, dtype=np.uint8)
        padded[: len(body)] = body if fold is None else fold[body]
        first = np.searchsorted(starts, at)
        yield Words(low, high, padded, starts, np.flatnonzero(stops) + 1, first)
        low = high


def windows(values: np.ndarray, size: int, base: int = 0x2545F4914F6CDD1D) -> np.ndarray:
    """A mixed 64-bit hash of every ``size`` consecutive values; one per start."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    # polynomial in the base: blocks of 1, 2, 4 ... values are put together as size's bits say
    block, width, done, out = values.astype(U64, copy=False), 1, 0, None
    while True:
        if size & width:
            part = block[done : done + n]
            out = part.copy() if out is None else out * U64(pow(base, width, 1 << 64)) + part
            done += width
        if width * 2 > size:
            return mix(out + _STEP)
        block = block[:-width] * U64(pow(base, width, 1 << 64)) + block[width:]
        width *= 2


def as_long(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
