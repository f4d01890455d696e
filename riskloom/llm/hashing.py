"""Hashes of words and word runs, on whole Arrow columns.

Words are runs of bytes other than 0x20 and 0x09-0x0D. All of these bytes are ASCII, so
working on UTF-8 bytes gives the same words as working on characters. The hash of a run is
a polynomial over its parts modulo 2**64 with a final mix, read off prefix sums, so its
cost doesn't depend on the length of the run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from riskloom.llm.common import slices

_BASE = 0x9E3779B97F4A7C55
_MASK = (1 << 64) - 1
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, from 0 to n at least."""
    global _powers, _inverse
    if len(_powers) <= n:
        size = max(n + 1, 1 << 16)
        ones = np.ones(size, np.uint64)
        ones[1:] = _BASE
        _powers = np.cumprod(ones, dtype=np.uint64)
        ones[1:] = pow(_BASE, -1, _MASK + 1)
        _inverse = np.cumprod(ones, dtype=np.uint64)
    return _powers, _inverse


def run_hashes(parts: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``parts[start:end]`` for each pair; ``parts`` are 64-bit numbers."""
    powers, inverse = _tables(len(parts))
    sums = np.zeros(len(parts) + 1, np.uint64)
    np.cumsum(parts * powers[: len(parts)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def _segments(raw: np.ndarray, gap: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Cuts of a long text at separators, so that a run of words is hashed at a time."""
    start = 0
    while len(raw) - start > size:
        step = np.flatnonzero(gap[start + size :][: 1 << 16])
        if not len(step):
            step = np.flatnonzero(gap[start + size :])
        if not len(step):
            break
        end = start + size + int(step[0])
        yield start, end
        start = end
    yield start, len(raw)


def words(
    raw: np.ndarray, offsets: np.ndarray, lower: bool = False, segment: int = 1 << 18
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of each word, and the n + 1 word offsets of the rows."""
    hashes, firsts, lasts = [], [], []
    gap = (raw == 32) | ((raw >= 9) & (raw <= 13))
    begins = ~gap
    begins[1:] &= gap[:-1]
    edge = offsets[:-1][offsets[:-1] < len(raw)]
    begins[edge] = ~gap[edge]
    stops = ~gap
    stops[:-1] &= gap[1:]
    edge = offsets[1:][offsets[1:] > 0] - 1
    stops[edge] = ~gap[edge]
    for start, end in _segments(raw, gap, segment):
        piece = raw[start:end]
        if lower:
            piece = piece + np.uint8(32) * ((piece >= 65) & (piece <= 90))
        first, last = np.flatnonzero(begins[start:end]), np.flatnonzero(stops[start:end]) + 1
        hashes.append(run_hashes(piece.astype(np.uint64) + np.uint64(1), first, last))
        firsts.append(first + start)
        lasts.append(last + start)
    first = np.concatenate(firsts)
    return np.concatenate(hashes), first, np.concatenate(lasts), np.searchsorted(first, offsets)


def grams(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside rows, and their n + 1 offsets by row."""
    counts = np.maximum(np.diff(bounds) - size + 1, 0)
    edges = np.concatenate([[0], np.cumsum(counts)])
    starts = np.arange(edges[-1]) + np.repeat(bounds[:-1] - edges[:-1], counts)
    return run_hashes(hashes, starts, starts + size), edges


def row_slices(raw: np.ndarray, offsets: np.ndarray, size: int = 1 << 18):
    """Runs of rows as (first row, last row, their bytes, their offsets)."""
    for start, end in slices(offsets, size):
        yield start, end, raw[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start]
