"""Hashed byte trigrams of whole texts, in dense blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from riskloom.llm.common import slices, utf8

WIDTH = 4096
_ROWS = 128
_SLICE, _PART = 1 << 18, 1 << 20  # bytes of several texts, and of one long text, at a time

FOLDED = np.arange(256, dtype=np.uint8)  # letters in lower case, other ASCII as a space
FOLDED[:128] = 32
FOLDED[97:123] = np.arange(97, 123)
FOLDED[65:91] = np.arange(97, 123)


def counts(texts: pa.Array, fold: np.ndarray | None = None) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, end row, trigram counts of these rows): every byte counts, however long."""
    raw, offsets = utf8(texts)
    for first, end in slices(offsets, _SLICE):
        for start in range(first, end, _ROWS):
            stop = min(start + _ROWS, end)
            own = offsets[start : stop + 1] - offsets[start]
            found = np.zeros((stop - start) * WIDTH, np.float32)
            for a in range(0, max(int(own[-1]), 1), _PART):  # a long text in parts
                b = min(int(own[-1]), a + _PART + 2)
                part = raw[offsets[start] + a : offsets[start] + b]
                if len(part) < 3:
                    continue
                part = (fold[part] if fold is not None else part).astype(np.uint32)
                mixed = part[:-2] * np.uint32(0x9E3779B1) + part[1:-1] * np.uint32(0x85EBCA77)
                mixed += part[2:] * np.uint32(0xC2B2AE3D)
                row = np.searchsorted(own, a + np.arange(len(mixed)), "right") - 1
                inside = a + np.arange(len(mixed)) + 3 <= own[row + 1]
                place = row[inside] * WIDTH + (mixed[inside] >> np.uint32(20))
                found += np.bincount(place, minlength=len(found))
            yield start, stop, found.reshape(-1, WIDTH)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; a zero row stays zero."""
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norms > 0, norms, 1)
