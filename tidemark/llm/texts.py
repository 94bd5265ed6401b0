"""Texts of Arrow batches as numpy arrays: bytes, words, hashes of substrings.

Everything here works inside one task, on one batch or one bounded group."""

from __future__ import annotations

import ctypes
import hashlib
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard

#: ASCII white space, ``[\x20\x09-\x0D]``: what separates words.
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

_ODD = 0x9E3779B97F4A7C15
#: Units (bytes or words) that are hashed at a time.
CHUNK = 1 << 18

#: Bytes of a word from which on it has a digest of its own.
LONG_WORD = 64

#: Arrays from this size on go back to the system when they are freed. The C library would raise
#: the limit to 32 MiB by itself, and workers, which live on, keep what their largest task took.
_RETURNED, _M_MMAP_THRESHOLD = 4 << 20, -3
if hasattr(ctypes.CDLL(None), "mallopt"):
    ctypes.CDLL(None).mallopt(_M_MMAP_THRESHOLD, _RETURNED)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A random value for each byte.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))


class _Powers:
    """Powers of the hash's base and of its inverse modulo 2**64, as far as were needed yet."""

    base = 0xD6E8FEB86659FD93
    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def reach(cls, n: int) -> None:
        if cls.up.size <= n:
            size = max(n + 1, CHUNK + 4096)
            inverse = pow(cls.base, -1, 1 << 64)
            for name, value in (("up", cls.base), ("down", inverse)):
                powers = np.full(size, value, dtype=np.uint64)
                powers[0] = 1
                setattr(cls, name, np.cumprod(powers, dtype=np.uint64))


class Hashes:
    """Hashes of any substring of a sequence of 64-bit units, from sums of prefixes."""

    def __init__(self, units: np.ndarray) -> None:
        _Powers.reach(units.size)
        self.sums = np.zeros(units.size + 1, dtype=np.uint64)
        np.cumsum(units * _Powers.up[: units.size], out=self.sums[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the substrings from ``start`` to before ``end``; their high bits are the
        good ones."""
        return (self.sums[end] - self.sums[start]) * _Powers.down[start]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mixed hashes of the substrings from ``start`` to before ``end``."""
        return mix(self.raw(start, end))

    def all_of(self, length: int) -> np.ndarray:
        """Mixed hashes of every substring of ``length`` units."""
        count = self.sums.size - length
        return mix((self.sums[length:] - self.sums[:count]) * _Powers.down[:count])


class Batch:
    """Texts of one Arrow column as bytes laid end to end; NULL is an empty text."""

    def __init__(self, column: pa.Array) -> None:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):  # no chunks at all
            column = pa.array([], pa.large_binary())
        if column.null_count:
            column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
        wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
        _, offsets, data = column.buffers()
        kind = np.int64 if wide else np.int32
        if offsets is None or not len(column):
            self.bounds = np.zeros(len(column) + 1, dtype=np.int64)
        else:
            self.bounds = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        self.data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)

    def __len__(self) -> int:
        return self.bounds.size - 1

    def bytes_of(self, i: int) -> memoryview:
        return memoryview(self.data[self.bounds[i] : self.bounds[i + 1]])

    def chunks(self, size: int = CHUNK) -> Iterator[tuple[int, int]]:
        """Ranges of consecutive texts with about ``size`` bytes; a longer text is alone."""
        start = 0
        while start < len(self):
            end = int(np.searchsorted(self.bounds, self.bounds[start] + size, side="right")) - 1
            end = min(max(end, start + 1), len(self))
            yield start, end
            start = end


def sliced(batches: Iterator[pa.RecordBatch], size: int = 12 << 20, text: int = 1) -> Iterator[pa.RecordBatch]:
    """Batches in slices of about ``size`` bytes of text, which is the column ``text``."""
    for rows in batches:
        for start, end in Batch(rows.column(text)).chunks(size):
            yield rows.slice(start, end - start)


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word of the texts that ``bounds`` cuts ``data`` into, and the
    number of words before each text and in all. No word reaches over a bound."""
    base = bounds[0]
    data, bounds = data[base : bounds[-1]], bounds - base
    solid = ~WHITE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    filled = bounds[:-1][bounds[1:] > bounds[:-1]]
    first[filled] = solid[filled]
    ends = bounds[1:][bounds[1:] > bounds[:-1]] - 1
    last[ends] = solid[ends]
    starts = np.flatnonzero(first)
    return starts + base, np.flatnonzero(last) + 1 + base, np.searchsorted(starts, bounds)


def word_values(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit value for each word's bytes. Long texts are hashed piece by piece.

    Sums of powers modulo 2**64 agree for some pairs of long sequences whatever the base is (those
    of Thue and Morse, from 1024 letters on), so words beyond ``LONG_WORD`` bytes have a
    cryptographic digest instead."""
    values = np.empty(starts.size, dtype=np.uint64)
    at = 0
    while at < starts.size:
        to = max(int(np.searchsorted(ends, starts[at] + CHUNK, side="right")), at + 1)
        base = starts[at]
        hashes = Hashes(BYTE_VALUES[data[base : ends[to - 1]]])
        values[at:to] = hashes.of(starts[at:to] - base, ends[at:to] - base)
        at = to
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        digest = hashlib.blake2b(memoryview(data[starts[i] : ends[i]]), digest_size=8).digest()
        values[i] = int.from_bytes(digest, "little")
    return values


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value, byte by byte of their items for better compression."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    parts = []
    for array in arrays:
        array = np.ascontiguousarray(array)
        rows = array.view(np.uint8).reshape(array.size, -1) if array.size else np.zeros((0, 1), np.uint8)
        body = squeeze(np.ascontiguousarray(rows.T).tobytes())
        parts += [struct.pack("<4sqq", array.dtype.str[1:].encode(), array.size, len(body)), body]
    return b"".join(parts)


def unpack(value: bytes) -> list[np.ndarray]:
    """The arrays that :func:`pack` was given."""
    expand, arrays, at = zstandard.ZstdDecompressor().decompress, [], 0
    while at < len(value):
        kind, count, size = struct.unpack_from("<4sqq", value, at)
        at += struct.calcsize("<4sqq")
        dtype = np.dtype(kind.rstrip(b"\0").decode())
        if count:
            body = np.frombuffer(expand(value[at : at + size]), dtype=np.uint8)
            arrays.append(np.ascontiguousarray(body.reshape(dtype.itemsize, count).T).view(dtype).reshape(count))
        else:
            arrays.append(np.zeros(0, dtype=dtype))
        at += size
    return arrays


def unpack_all(values: Sequence[bytes], kinds: Sequence[str]) -> list[np.ndarray]:
    """The arrays of many packed values, each joined with its like."""
    columns, joined = [unpack(value) for value in values], []
    for kind in kinds:
        joined.append(np.concatenate([c.pop(0) for c in columns]) if columns else np.zeros(0, kind))
    return joined


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values
