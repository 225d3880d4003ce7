"""Vectorised helpers over the UTF-8 bytes of an Arrow text column.

A batch is cut into blocks of whole documents (about ``block_bytes`` each, one
long document being a block of its own), so memory follows the block and the
longest document, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Odd multiplier of the polynomial hash and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)
BLOCK_BYTES = 1 << 20

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


class Block(NamedTuple):
    """Rows ``first .. first + len(start) - 1`` of a batch as one byte array."""

    first: int
    data: np.ndarray       # uint8, the documents' bytes one after another
    start: np.ndarray      # int64, first byte of each document
    end: np.ndarray        # int64, one past its last byte


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_table(seed: int, fold_case: bool) -> np.ndarray:
    """A random 64-bit value for each byte; with ``fold_case`` A-Z get those of a-z."""
    table = mix(np.arange(256, dtype=np.uint64) + np.uint64(seed * 1000003 + 1))
    if fold_case:
        table[65:91] = table[97:123]
    return table


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE**i`` and ``BASE**-i`` modulo 2**64 for i below n (grown on demand)."""
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 4096)
        for k, b in enumerate((BASE, BASE_INV)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The documents of a string column, null as empty, in blocks."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    lengths = np.diff(offsets)
    if column.null_count:
        lengths = np.where(np.asarray(column.is_null()), 0, lengths)
    at = 0
    while at < n:
        stop = int(np.searchsorted(offsets, offsets[at] + block_bytes, "right")) - 1
        stop = min(n, max(stop, at + 1))
        start = (offsets[at:stop] - offsets[at]).astype(np.int64)
        yield Block(at, data[offsets[at]:offsets[stop]], start, start + lengths[at:stop])
        at = stop


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """256 booleans, true for the bytes of the inclusive ranges."""
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a:b + 1] = True
    return out


#: The complement of ``[^\x20\x09-\x0D]``.
SPACES = separators((0x20, 0x20), (0x09, 0x0D))


def words(block: Block, separator: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, one past the last byte, and document of every word, in order."""
    inside = ~separator[block.data]
    n = len(inside)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    before = np.empty(n, bool)
    before[0] = True
    np.logical_not(inside[:-1], out=before[1:])
    before[block.start[block.start < n]] = True
    after = np.empty(n, bool)
    after[-1] = True
    np.logical_not(inside[1:], out=after[:-1])
    stops = block.start[(block.start > 0) & (block.start < n + 1)] - 1
    after[stops] = True
    first = np.flatnonzero(inside & before)
    last = np.flatnonzero(inside & after) + 1
    return first, last, np.searchsorted(block.start, first, "right") - 1


def prefix_hash(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """``len(data) + 1`` prefix sums; see ``span_hash``."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * powers(len(data))[0], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, the same wherever the span stands."""
    return mix((prefix[last] - prefix[first]) * powers(len(prefix))[1][first])


def word_hashes(block: Block, table: np.ndarray,
                separator: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every word of a block."""
    first, last, doc = words(block, separator)
    return span_hash(prefix_hash(block.data, table), first, last), doc


def ngram_hashes(word: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n consecutive word hashes that start at each of the first ``len - n + 1`` places."""
    m = len(word) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out = out * np.uint64(BASE) + word[k:k + m]
    return mix(out)
