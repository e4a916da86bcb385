"""Vectorised text primitives on Arrow buffers: bytes, words, hashes.

A task sees its texts as one byte array with offsets.  Every function works on a
bounded slice of rows (see ``slices``), so memory does not follow the batch size
that Spark picks; a single longer text forms a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on uint64."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def byte_table(ranges: list[tuple[int, int]], inside: bool = True) -> np.ndarray:
    """A 256-entry mask: True for bytes in (or outside) the given closed ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table if inside else ~table


#: Words as runs of anything but blanks, and as runs of ASCII letters, digits and non-ASCII.
NON_BLANK = byte_table([(0x20, 0x20), (0x09, 0x0D)], inside=False)
ALNUM = byte_table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)], inside=False)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        have = np.ones(1, dtype=np.uint64)
        while len(have) < size:
            have = np.concatenate([have, have * np.uint64(pow(base, len(have), 1 << 64))])
        have = have[:size]
        if size <= 4 * SLICE_BYTES:
            _powers[base] = have
    return have[:n]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets (from 0) of a string or binary array; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)):
        column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_large_binary(column.type) else "")
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[offs[0]:offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row slices holding about ``max_bytes`` of the column, one row at least."""
    _, offs = buffers(batch.column(column))
    n, at = batch.num_rows, 0
    while at < n:
        to = int(np.searchsorted(offs, offs[at] + max_bytes, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield batch.slice(at, to - at)
        at = to


def words(raw: np.ndarray, offs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and n + 1 offsets of the texts' words.  No word crosses a text's end."""
    if not len(raw):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offs), np.int64)
    inside = table[raw]
    first = np.empty(len(raw), bool)
    first[0], first[1:] = True, ~inside[:-1]
    last = np.empty(len(raw), bool)
    last[-1], last[:-1] = True, ~inside[1:]
    filled = offs[:-1] < offs[1:]
    first[offs[:-1][filled]] = True
    last[offs[1:][filled] - 1] = True
    starts, ends = np.flatnonzero(first & inside), np.flatnonzero(last & inside) + 1
    return starts, ends, np.searchsorted(starts, offs)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every byte span, the same wherever the span lies (polynomial over random byte values)."""
    n = len(raw)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[raw] * _power(_BASE, n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power(_INVERSE, n + 1)[starts] + (ends - starts).astype(np.uint64) * _GOLD)


def gram_hashes(values: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive values; len(values) - n + 1 of them."""
    size = max(0, len(values) - n + 1)
    total = np.full(size, n, np.uint64)
    for k in range(n):
        total = total * np.uint64(_BASE) + values[k:k + size]
    return mix(total)


def ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts (c0, c1, ..): the owner 0,0,..,1,.. and the place 0,1,..,0,.. of each of sum(c) items."""
    owner = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    return owner, np.arange(len(owner)) - np.repeat(ends - counts, counts)


def eight_bytes(raw: np.ndarray) -> np.ndarray:
    """Big-endian value of the 8 bytes at every place (zeros beyond the end): compares like the bytes."""
    n = len(raw)
    wide = np.zeros(n + 8, np.uint8)
    wide[:n] = raw
    value = wide[:n].astype(np.uint64)
    for k in range(1, 8):
        value <<= np.uint64(8)
        value |= wide[k:k + n]
    return value
