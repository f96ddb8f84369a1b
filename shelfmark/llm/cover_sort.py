"""Suffix order of a block of text by difference-cover samples: one bucket of suffixes at a time, so memory stays with the block."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

PERIOD = 32


@lru_cache(4)
def cover(period: int = PERIOD) -> tuple[np.ndarray, np.ndarray]:
    """A difference cover of 0..period-1 (greedy), and shift[i, j]: the least d so that i + d and j + d are both in it, modulo the period."""
    chosen, have = [0], {0}
    while len(have) < period:
        best = max(range(period), key=lambda x: (len({(x - c) % period for c in chosen} | {(c - x) % period for c in chosen} | have), -x))
        chosen.append(best)
        have |= {(a - b) % period for a in chosen for b in chosen}
    inside = np.zeros(period, bool)
    inside[chosen] = True
    i = np.arange(period)
    shift = np.full((period, period), -1, np.int64)
    for d in range(period - 1, -1, -1):
        both = inside[(i + d) % period][:, None] & inside[(i + d) % period][None, :]
        shift[both] = d
    return inside, shift


def words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as a number that sorts as they do; zeros stand behind the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    return np.ndarray((len(text),), ">u8", padded.data, strides=(1,)).astype(np.uint64)


def _keys(w: np.ndarray, at: np.ndarray, depth: int) -> list[np.ndarray]:
    """The first depth bytes of the suffixes as numbers, most significant first."""
    out = []
    for k in range(0, depth, 8):
        p = at + k
        x = np.where(p < len(w), w[np.minimum(p, len(w) - 1)], 0).astype(np.uint64)
        out.append(x if depth - k >= 8 else x & ~np.uint64((1 << (8 * (8 - (depth - k)))) - 1))
    return out


def _ranked(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order by the keys, and the dense rank of each element of that order."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    return order, np.cumsum(new)


def sorted_suffixes(text: np.ndarray, at: np.ndarray, depth: int, bucket: int = 1 << 18):
    """Yields the suffixes that begin at `at`, in order of at least their first depth bytes, bucket by bucket.

    The sample's suffixes are ranked first.  A bucket holds the suffixes between two splitters; it is sorted by its first 32 bytes, and
    suffixes that tie there are compared by the ranks at the shift that takes both into the sample: against a pivot, all ties side by side."""
    if not len(at):
        return
    inside, shift = cover()
    w = words(text)
    sample = np.flatnonzero(inside[np.arange(len(text)) % PERIOD])
    order, dense = _ranked(_keys(w, sample, depth))
    rank = np.full(len(text) + PERIOD, -1, np.int64)  # behind the end: smaller than all
    rank[sample[order]] = dense
    first = w[at]
    splitters = np.unique(np.sort(first)[bucket::bucket])
    home = np.searchsorted(splitters, first, "right")
    for b in range(len(splitters) + 1):
        mine = at[home == b] if len(splitters) else at
        if len(mine):
            yield _bucket(w, mine, rank, shift)


def _bucket(w: np.ndarray, at: np.ndarray, rank: np.ndarray, shift: np.ndarray) -> np.ndarray:
    order, group = _ranked(_keys(w, at, PERIOD))
    at = at[order]
    open_ = np.flatnonzero(np.bincount(group)[group] > 1)  # places whose suffix ties with others
    while len(open_):
        g = group[open_]
        begins = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
        sizes = np.diff(np.append(begins, len(g)))
        pivot = np.repeat(at[open_[begins + sizes // 2]], sizes)
        p = at[open_]
        d = shift[p % PERIOD, pivot % PERIOD]
        a, b = rank[p + d], rank[pivot + d]
        side = np.where(a < b, 0, np.where(a == b, 1, 2))
        o = np.lexsort((side, g))
        at[open_] = p[o]
        side, g = side[o], g[o]
        fresh = np.append(True, (g[1:] != g[:-1]) | (side[1:] != side[:-1]))
        sub = np.cumsum(fresh) - 1
        group[open_] = sub
        open_ = open_[(side != 1) & (np.bincount(sub)[sub] > 1)]
    return at


def equal_runs(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Number of the run of suffixes with equal first depth bytes, for each place of a suffix order."""
    w = words(text)
    new = np.zeros(len(order), bool)
    for k in _keys(w, order, depth):
        new[1:] |= k[1:] != k[:-1]
    return np.cumsum(new)
