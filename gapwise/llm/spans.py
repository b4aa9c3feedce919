"""Hashes of spans of bytes and of 64-bit integers, many at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes that are worked on at once; a longer text comes in windows.
WINDOW = 1 << 20

U64 = np.uint64
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
#: A random value for each byte; `LOWER` has the same ones for A-Z as for a-z.
VALUES = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 64, 256, np.uint64, endpoint=False)
LOWER = VALUES.copy()
LOWER[65:91] = VALUES[97:123]
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit integers (a public finalizer)."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A hash of data[start:end] for each span: a polynomial in the values of its bytes."""
    if not _POWERS or len(_POWERS[0]) <= len(data):
        n = max(len(data), WINDOW) + 1
        _POWERS[:] = [_powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * _POWERS[0][: len(data)], out=sums[1:])
    return mix((sums[end] - sums[start]) * _POWERS[1][start] + (end - start).astype(np.uint64))


def words(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run without white space; none reaches over a position in `cuts`."""
    inked = ~BLANK[data]
    begins, ends = inked.copy(), inked.copy()
    begins[1:] &= ~inked[:-1]
    ends[:-1] &= ~inked[1:]
    at = cuts[cuts < len(data)]
    begins[at] = inked[at]
    before = at[at > 0] - 1
    ends[before] = inked[before]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of an Arrow array of texts (null: empty)."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    return (np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)), offsets


def blocks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about a window of bytes, or one longer text."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + WINDOW, "right")) - 1)
        yield row, last
        row = last


def windows(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in windows that begin at a lone blank before a word, where it has any."""
    at = 0
    while at < len(data):
        size = WINDOW
        while True:
            window = data[at : at + size]
            if at + size >= len(data):
                break
            blank = BLANK[window]
            lone = np.flatnonzero((window[1:-1] == 32) & ~blank[:-2] & ~blank[2:])
            if len(lone):
                window = window[: lone[-1] + 1]
                break
            size *= 2
        yield window
        at += len(window)
