"""Numpy kernels over whole texts, shared by the operators of this subpackage.

Every kernel works on the UTF-8 bytes of a few texts laid end to end, so that a column is handled
without a Python loop over characters or words. Texts are taken in chunks of about ``CHUNK`` bytes;
a longer text is a chunk of its own, so memory follows the longest text, never the table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19
BASE = 0xBF58476D1CE4E5B9
MIX = np.uint64(0x94D049BB133111EB)
_U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit hashes."""
    h = h ^ (h >> _U(30))
    h = h * _U(BASE)
    h ^= h >> _U(27)
    h *= MIX
    h ^= h >> _U(31)
    return h


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column end to end, and n + 1 offsets into them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        column = column.cast(pa.binary() if pa.types.is_large_binary(column.type) else pa.string())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]], ends - ends[0]


def chunks(data: np.ndarray, ends: np.ndarray, most: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of neighbouring texts of about ``most`` bytes."""
    n = len(ends) - 1
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + most, "right")) - 1)
        yield i, j, data[ends[i]:ends[j]], ends[i:j + 1] - ends[i]
        i = j


def owners(ends: np.ndarray) -> np.ndarray:
    """For every byte, the row of its text."""
    return np.repeat(np.arange(len(ends) - 1), np.diff(ends))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of bytes other than space and tab to carriage return; no run crosses texts."""
    inside = ~_SPACE[data]
    if not inside.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(len(data) + 1, bool)
    cut[ends] = True
    before = np.concatenate(([False], inside[:-1]))
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.concatenate((inside[1:], [False]))
    stops = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, stops


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, kept as long as the longest chunk so far."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, CHUNK + 4096)
            cls.up = np.cumprod(np.concatenate(([_U(1)], np.full(size - 1, BASE, np.uint64))), dtype=np.uint64)
            inverse = pow(BASE, -1, 1 << 64)
            cls.down = np.cumprod(np.concatenate(([_U(1)], np.full(size - 1, inverse, np.uint64))).astype(np.uint64), dtype=np.uint64)
        return cls.up[:n], cls.down[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, the same wherever the span stands."""
    up, down = Powers.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + _U(1)) * up[:len(data)], out=sums[1:])
    return mix((sums[stops] - sums[starts]) * down[starts])


def shingles(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` neighbouring words and their rows; a row with fewer words gives its whole sequence once.

    ``rows`` is ascending. A row without words gives nothing.
    """
    n = len(hashes)
    if n == 0:
        return hashes, rows
    factors = [_U(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64)) for k in range(size)]
    joined = np.zeros(n, np.uint64)
    for k, factor in enumerate(factors):
        joined[:n - k] += mix(hashes[k:] + factor) * factor
    last = np.minimum(np.arange(n) + size - 1, n - 1)
    full = (rows[last] == rows) & (np.arange(n) + size - 1 < n)
    out_h, out_r = mix(joined[full]), rows[full]
    first = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
    count = np.diff(np.append(first, n))
    short = count < size
    if short.any():
        extra_h, extra_r = [], []
        for at, c in zip(first[short].tolist(), count[short].tolist(), strict=True):
            few = np.array(factors[:c])
            extra_h.append((mix(hashes[at:at + c] + few) * few).sum(dtype=np.uint64) ^ _U(c))
            extra_r.append(rows[at])
        out_h = np.concatenate((out_h, mix(np.array(extra_h, np.uint64))))
        out_r = np.concatenate((out_r, np.array(extra_r, out_r.dtype)))
        order = np.argsort(out_r, kind="stable")
        out_h, out_r = out_h[order], out_r[order]
    return out_h, out_r


def distinct_per_row(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each row, ascending within the row; ``rows`` is ascending."""
    order = np.lexsort((hashes, rows))
    h, r = hashes[order], rows[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return h[keep], r[keep]


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Rows of lists from flat values and the length of each list."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def packed(*columns: np.ndarray) -> bytes:
    """Columns as planes of bytes, so that the bytes that are all zero cost nothing in a shuffle file."""
    return b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T).tobytes() for c in columns)


def unpacked(blob: bytes, kinds: Sequence[type]) -> list[np.ndarray]:
    """The columns of a packed block, of the given types."""
    sizes = [np.dtype(k).itemsize for k in kinds]
    n = len(blob) // sum(sizes)
    raw, at, out = np.frombuffer(blob, np.uint8), 0, []
    for kind, size in zip(kinds, sizes, strict=True):
        out.append(np.ascontiguousarray(raw[at:at + n * size].reshape(size, n).T).view(kind).ravel())
        at += n * size
    return out


def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
    """The blocks of each bucket, from rows (bucket, blob) sorted by bucket."""
    held: list[bytes] = []
    last = None
    for batch in batches:
        for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob").to_pylist(), strict=True):
            if held and bucket != last:
                yield held
                held = []
            last = bucket
            held.append(blob)
    if held:
        yield held
