"""Vectorised words, hashes and slices over Arrow string columns.

Every operator that runs in Python works on slices of a few megabytes of text, so
a worker's memory does not depend on the size of a partition or of an Arrow batch.
Words are byte-level: the separators of the contracts are all ASCII, and no byte of
a multi-byte UTF-8 character is ASCII, so splitting bytes splits characters right.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
LONG_WORD = 256

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Everything below 0x80 that is no ASCII letter or digit.
NOT_ALNUM = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
_M1, _M2, _M3 = U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], U64)


try:
    _LIBC = ctypes.CDLL("libc.so.6")
    _LIBC.malloc_trim.argtypes = [ctypes.c_size_t]
except (OSError, AttributeError):  # another C library
    _LIBC = None


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers whose output bits all depend on all input bits."""
    x = (x ^ (x >> U64(30))) * _M2
    x = (x ^ (x >> U64(27))) * _M3
    return x ^ (x >> U64(31))


def settle() -> None:
    """Gives freed memory back to the system; workers live on and serve other operators."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches into runs of whole rows with about `size` bytes of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + size, side="right")))
            yield batch.slice(at, to - at)
            at = to
    settle()


def buffer_of(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows together, and the rows' bounds; null counts as empty."""
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    if lower:
        column = pc.ascii_lower(column)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    off = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def spans(data: np.ndarray, off: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and where each row's words begin (rows + 1 bounds)."""
    inside = ~separator[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    firsts = off[:-1][off[:-1] < off[1:]]
    before[firsts] = False
    after[off[1:][off[:-1] < off[1:]] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, eight bytes at a time; long spans go through blake2b."""
    padded = np.zeros(len(data) + 16, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 8,), "<u8", padded, strides=(1,))
    size = ends - starts
    h = (size.astype(U64) + U64(1)) * _M1
    long = np.flatnonzero(size > LONG_WORD)
    live = np.flatnonzero((size > 0) & (size <= LONG_WORD))
    at = 0
    while len(live):
        left = size[live] - at
        h[live] = mix(h[live] ^ (eight[starts[live] + at] & _KEEP[np.minimum(left, 8)])) + _M1
        at += 8
        live = live[left > 8]
    for i in long:
        h[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return h


def same_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray, others: np.ndarray) -> bool:
    """Whether every span's bytes are those that begin at `others` in the other buffer, eight bytes at a time."""
    eight = lambda x: np.ndarray((len(x) + 8,), "<u8", np.concatenate([x, np.zeros(16, np.uint8)]), strides=(1,))
    size = ends - starts
    for i in np.flatnonzero(size > LONG_WORD):
        if (data[starts[i] : ends[i]] != other[others[i] : others[i] + size[i]]).any():
            return False
    here, there, live, at = eight(data), eight(other), np.flatnonzero((size > 0) & (size <= LONG_WORD)), 0
    while len(live):
        left = size[live] - at
        if ((here[starts[live] + at] ^ there[others[live] + at]) & _KEEP[np.minimum(left, 8)]).any():
            return False
        at += 8
        live = live[left > 8]
    return True


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of `width` consecutive items: len(h) - width + 1 of them."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    a = int(_M1)
    out, have, power, step = None, 0, h, 1
    for bit in range(width.bit_length()):
        if width >> bit & 1:
            out = power[: len(power)] if out is None else out[: len(h) - have - step + 1] * U64(pow(a, step, 1 << 64)) + power[have : have + len(h) - have - step + 1]
            have += step
        if width >> bit > 1:
            power = power[: len(power) - step] * U64(pow(a, step, 1 << 64)) + power[step:]
            step *= 2
    return mix(out[:n] + U64(width))


def row_of(bounds: np.ndarray) -> np.ndarray:
    """For each item the row it belongs to."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kept words of each row joined by one space: bytes and bounds."""
    k = np.flatnonzero(kept)
    rows = row_of(bounds)[k]
    last = np.ones(len(k), bool)
    last[:-1] = rows[1:] != rows[:-1]
    n = ends[k] - starts[k] + ~last
    to = np.cumsum(n)
    total = int(to[-1]) if len(k) else 0
    source = np.repeat(starts[k] - (to - n), n) + np.arange(total)
    out = np.append(data, np.uint8(32))[np.minimum(source, len(data))]
    out[to[~last] - 1] = 32
    per = np.bincount(rows, weights=n, minlength=len(bounds) - 1).astype(np.int64)
    return out, np.concatenate([[0], np.cumsum(per)])


def window_rows(bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First items of the windows that lie within one row, and those rows."""
    rows = row_of(bounds)
    first = np.flatnonzero(np.arange(len(rows)) + width <= bounds[1:][rows])
    return first, rows[first]


def blobs(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Runs of an array as binary values."""
    width = values.dtype.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * width).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, kind))


def crc_mod(ids: pa.Array, modulus: int) -> np.ndarray:
    """crc32 of the ids as text, modulo `modulus`; null ids count as the empty text."""
    import zlib

    return np.array([zlib.crc32(b"" if x is None else str(x).encode()) % modulus for x in ids.to_pylist()], np.int64)
