"""Simple-8b: 64-bit words whose top four bits say how many values of how many bits the other sixty hold."""

from __future__ import annotations

import numpy as np

BLOCK = 256  # values per block; every block begins with a word of its own

# Values in a word and bits of each, by selector.  Selector 0 is the escape: the next word is one raw value of over 60 bits.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])

_LIMITS = np.array([1 << int(b) for b in BITS[1:]], np.uint64)
_SMALL = np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64), "right").astype(np.uint8)


def _widths(values: np.ndarray) -> np.ndarray:
    """Lowest selector rank that holds each value: 0 for zero bits ... 14 for sixty, 15 for an escape."""
    if len(values) and values.max() < len(_SMALL):
        return _SMALL[values]
    return np.searchsorted(_LIMITS, values, "right").astype(np.uint8)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, and for each block the index of its first word.  Each word takes the most values that fit, all blocks side by side."""
    values = np.asarray(values).astype(np.uint64)
    blocks = -(-len(values) // BLOCK)
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    pad = int(COUNTS.max())
    grid = np.zeros((blocks, BLOCK + pad), np.uint64)
    flat = np.zeros(blocks * BLOCK, np.uint64)
    flat[:len(values)] = values
    grid[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    widths = np.zeros(grid.shape, np.uint8)
    widths[:, :BLOCK] = _widths(flat).reshape(blocks, BLOCK)

    peaks = {1: widths}  # highest width among the next n values
    step = 1
    while step * 2 <= pad:
        a = peaks[step]
        peaks[step * 2] = np.maximum(a[:, :a.shape[1] - step], a[:, step:])
        step *= 2
    chosen = np.zeros((blocks, BLOCK), np.uint8)
    for selector in range(15, 0, -1):
        n = int(COUNTS[selector])
        p = 1 << (n.bit_length() - 1)
        peak = np.maximum(peaks[p][:, :BLOCK], peaks[p][:, n - p:n - p + BLOCK])
        np.copyto(chosen, np.uint8(selector), where=peak < selector)
    begins = np.zeros((blocks, BLOCK), bool)
    sizes = np.full(blocks, BLOCK)
    sizes[-1] = len(values) - (blocks - 1) * BLOCK
    block, at = np.arange(blocks), np.zeros(blocks, np.int64)
    while len(block):
        begins[block, at] = True
        at = at + COUNTS[chosen[block, at]]
        going = at < sizes[block]
        block, at = block[going], at[going]

    block, at = np.nonzero(begins)
    selectors = chosen[block, at]
    place = np.cumsum(1 + (selectors == 0)) - 1 - (selectors == 0)
    words = np.zeros(int(place[-1]) + 1 + int(selectors[-1] == 0), np.uint64)
    cell = block * grid.shape[1] + at
    grid = grid.reshape(-1)
    for selector in np.unique(selectors).tolist():
        some = np.flatnonzero(selectors == selector)
        first = cell[some]
        if selector == 0:
            words[place[some] + 1] = grid[first]
            continue
        n = int(COUNTS[selector])
        packed = np.full(len(some), selector << 60, np.uint64)
        for k in range(n if selector > 1 else 0):
            packed |= grid[first + k] << np.uint64(k * int(BITS[selector]))
        words[place[some]] = packed
    return words, place[np.searchsorted(block, np.arange(blocks))].astype(np.uint32)


def decode(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The n values, all words at once: block offsets say where a block's values go."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    selectors = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    raw[1:] = selectors[:-1] == 0  # a raw value has over 60 bits, so it is never taken for an escape itself
    counts = np.where(raw, 0, COUNTS[selectors])
    block = np.searchsorted(offsets, np.arange(len(words)), "right") - 1
    before = np.cumsum(counts) - counts
    at = before - before[offsets][block] + block * BLOCK
    ends = np.minimum((block + 1) * BLOCK, n)
    for selector in np.unique(selectors[~raw]).tolist():
        some = np.flatnonzero((selectors == selector) & ~raw)
        if selector == 0:
            out[at[some]] = words[some + 1]
        elif selector > 1:
            mask = np.uint64((1 << int(BITS[selector])) - 1)
            for k in range(int(COUNTS[selector])):
                inside = at[some] + k < ends[some]
                out[at[some][inside] + k] = (words[some][inside] >> np.uint64(k * int(BITS[selector]))) & mask
    return out


def decode_block(words: np.ndarray, offsets: np.ndarray, n: int, block: int) -> np.ndarray:
    """The values of one block only."""
    last = int(offsets[block + 1]) if block + 1 < len(offsets) else len(words)
    return decode(words[int(offsets[block]):last], np.zeros(1, np.uint32), min(BLOCK, n - block * BLOCK))
