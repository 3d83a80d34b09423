"""Word hashes of whole Arrow text columns with numpy: no Python work per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PRIME = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1
INVERSE = pow(PRIME, -1, 1 << 64)
PART_BYTES = 1 << 20
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[int, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept per process and grown by doubling."""
    have = _powers.get(base)
    if have is None:
        have = np.ones(1, np.uint64)
    while len(have) < n:
        have = np.concatenate([have, have * np.uint64(pow(base, len(have), 1 << 64))])
    _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def text_parts(column: pa.Array, part_bytes: int = PART_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets into them) for runs of rows of about `part_bytes`; NULL is empty."""
    column = column.fill_null("") if column.null_count else column
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + part_bytes, "right")) - 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word and the word offsets of the rows. Words are runs without ASCII white space."""
    n = len(data)
    white = WHITE[data]
    start = ~white
    start[1:] &= white[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[first] = ~white[first]  # a row begins anew
    starts = np.flatnonzero(start)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    end = ~white
    end[:-1] &= white[1:]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    end[last] = ~white[last]
    ends = np.flatnonzero(end) + 1
    total = np.zeros(n + 1, np.uint64)
    letters = (LOWER[data] if lower else data).astype(np.uint64) + np.uint64(1)
    np.cumsum(letters * _powers_of(PRIME, n), out=total[1:])
    raw = (total[ends] - total[starts]) * _powers_of(INVERSE, n)[starts]
    return mix(raw + (ends - starts).astype(np.uint64)), np.searchsorted(starts, offsets)
