"""Vectorised word handling over Arrow string buffers.

Texts are handled as UTF-8 bytes, about a megabyte at a time, so that memory is
bounded by ``BLOCK_BYTES`` (or by the longest single text) and not by the batch
that Spark sends.  Null texts count as empty.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
#: Most powers that a worker keeps, 16 bytes each; a longer text has its own, for as long as it is handled.
KEPT_POWERS = (1 << 22) + (1 << 18)

_libc = ctypes.CDLL(None)


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; after the last the worker, which later stages use again, returns the memory that it no longer needs."""
    yield from batches
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)

U64 = np.uint64
_MULT = 0x9E3779B97F4A7C15 | 1
_powers = (np.ones(1, U64), np.ones(1, U64))

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


def byte_class(spans: list[tuple[int, int]]) -> np.ndarray:
    """A 256-entry table that is true for the bytes in the inclusive spans."""
    table = np.zeros(256, bool)
    for low, high in spans:
        table[low : high + 1] = True
    return table


#: Words are runs of anything but space and the controls 09-0D.
SPACE_SEPARATED = ~byte_class([(0x20, 0x20), (0x09, 0x0D)])
#: Words are runs of ASCII digits, lower-cased letters and bytes beyond ASCII.
ALPHANUMERIC = ~byte_class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])


def _multiples(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_MULT, -1, 1 << 64)
    made = []
    for base in (_MULT, inverse):
        steps = np.full(n, base, U64)
        steps[0] = 1
        made.append(np.multiply.accumulate(steps))
    return made[0], made[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash multiplier and of its inverse modulo 2**64; those that usual blocks need are kept."""
    global _powers
    if n > KEPT_POWERS:
        return _multiples(n)
    if len(_powers[0]) < n:
        _powers = _multiples(max(n, 1 << 16))
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@dataclass
class TextBlock:
    """Some consecutive texts of a batch: their bytes and where each begins."""

    first: int  # row in the batch
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, one more than there are texts

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> str:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes().decode("utf-8", "replace")


def string_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    if not pa.types.is_string(column.type) and not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array | pa.ChunkedArray, size: int = BLOCK_BYTES) -> Iterator[TextBlock]:
    """Consecutive runs of whole texts of about `size` bytes; a longer text is a block of its own."""
    data, offsets = string_buffers(column)
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(n, max(last, first + 1))
        yield TextBlock(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


@dataclass
class WordBlock:
    """Words of a block: byte spans, hashes and, for each text, the first word."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    offsets: np.ndarray  # into the words, one more than there are texts

    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)


def word_spans(block: TextBlock, data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of word bytes; a run ends where its text does."""
    inside = is_word[data]
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    edges = block.offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[edges]
    stops[edges - 1] = inside[edges - 1]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, equal for equal bytes wherever they stand."""
    if not len(starts):
        return np.zeros(0, U64)
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[:-1], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * down[starts]
    return mix(raw + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def words(block: TextBlock, is_word: np.ndarray, lower: bool = True) -> WordBlock:
    data = ASCII_LOWER[block.data] if lower else block.data
    starts, ends = word_spans(block, data, is_word)
    return WordBlock(starts, ends, span_hashes(data, starts, ends), np.searchsorted(starts, block.offsets))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1 ... for each (start, length), end to end."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return np.arange(total, dtype=np.int64) + shift
