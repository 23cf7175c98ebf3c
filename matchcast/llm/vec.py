"""Vectorised text primitives over Arrow string columns: no Python string is made for a word or a shingle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

#: Bytes of white space: space and 9 to 13.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of words when punctuation separates: ASCII letters and digits, and every byte of a non-ASCII character.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Maps A-Z to a-z and leaves other bytes.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    at = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, most: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about so many bytes each; a longer row stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_grown: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; the longest asked for so far are kept."""
    if len(_grown[0]) < n:
        size = -(-n // 65536) * 65536
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _grown[k] = np.multiply.accumulate(steps)
    return _grown[0][:n], _grown[1][:n]


def words(data: np.ndarray, offsets: np.ndarray, wordy: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of maximal runs of bytes for which ``wordy`` holds; runs end with their row."""
    if not len(data):
        e = np.zeros(0, np.int64)
        return e, e, e
    inside = wordy[data]
    fresh = np.zeros(len(data) + 1, bool)
    fresh[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | fresh[1:-1]
    stops = inside
    stops[:-1] &= ~inside[1:] | fresh[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, the same wherever the span stands."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64) * U64(0xD1B54A32D192ED03))


def shingles(hashes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and first word's place of every run of ``k`` words; a row with fewer words gives its whole sequence."""
    n = len(hashes)
    if not n:
        return hashes, rows, np.zeros(0, np.int64)
    up, down = powers(n + 1)
    total = np.zeros(n + 1, U64)
    np.cumsum(hashes * up[:-1], out=total[1:])
    full = np.zeros(n, bool)
    if n >= k:
        full[: n - k + 1] = rows[: n - k + 1] == rows[k - 1 :]
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    few = first[~full[first]]
    full[few] = True
    at = np.flatnonzero(full)
    size = np.full(len(at), k)
    if len(few):
        size[np.searchsorted(at, few)] = (np.r_[first[1:], n] - first)[~np.isin(first, few, invert=True)]
    return mix((total[at + size] - total[at]) * down[at] + size.astype(U64) * U64(0x8EBC6AF09C88C6E3)), rows[at], at


def ragged(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. of each run of the given lengths."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
