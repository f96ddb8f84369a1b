"""Words of texts as spans and hashes, with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from shelfmark.llm.common import mix, slices, span_hashes

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # A-Z only

#: Bytes of [^\x20\x09-\x0D] and of [^\x00-\x2F\x3A-\x60\x7B-\x7F] (after lower-casing); both hold every byte beyond ASCII.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, *range(9, 14)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

GROUP_BYTES = 2 << 20


def groups(offs: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of about limit bytes together."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = j


def words(data: np.ndarray, offs: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of all words, and the first word of each document (n + 1 numbers).  data is lower-cased already."""
    starts, ends, hashes, at = [], [], [], 0
    for part, bounds, _ in slices(data, offs):
        if not len(part):
            continue
        inside = letters[part]
        edge = np.append(inside, False)
        before = np.append(False, inside)
        before[bounds[:-1]] = False
        s = np.flatnonzero(edge & ~before)
        after = np.append(inside[1:], False) if len(inside) else inside
        after[bounds[1:-1] - 1] = False
        e = np.flatnonzero(inside & ~after) + 1
        hashes.append(span_hashes(part, s, e))
        starts.append(s + at)
        ends.append(e + at)
        at += len(part)
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(len(offs), np.int64)
    starts = np.concatenate(starts)
    return starts, np.concatenate(ends), np.concatenate(hashes), np.searchsorted(starts, offs)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of width words, also of those that cross documents (the caller leaves them out)."""
    n = max(0, len(hashes) - width + 1)
    x = np.full(n, width, np.uint64)
    for k in range(width):
        x = x * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + n]
    return mix(x)
