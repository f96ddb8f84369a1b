"""Splits texts into pre-tokens with numpy, as the tokenizers' own split patterns do, so that each distinct pre-token is encoded once."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import numpy as np

from shelfmark.llm.common import mix, ragged, span_hashes

L, N, S, O, UNSURE, UNKNOWN = range(6)  # letter, number, white space, other, not assigned here, not looked up yet

# The characters of \s.
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# The endings split off after an apostrophe.
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]

_CLASS = np.full(0x110000, UNKNOWN, np.uint8)


def _look_up(points: np.ndarray) -> None:
    for p in points.tolist():
        kind = unicodedata.category(chr(p))
        _CLASS[p] = UNSURE if kind in ("Cn", "Cs") else {"L": L, "N": N}.get(kind[0], O)
    _CLASS[WHITE_SPACE] = S


_look_up(np.arange(0x250))


def chars(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte position, code point and class of each character of valid UTF-8."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at]
    points = lead.astype(np.int64)
    for low, high, n in ((0xC0, 0xE0, 1), (0xE0, 0xF0, 2), (0xF0, 0x100, 3)):
        some = np.flatnonzero((lead >= low) & (lead < high))
        if len(some):
            p = at[some]
            x = data[p].astype(np.int64) & (0x3F >> n)
            for k in range(1, n + 1):
                x = (x << 6) | (data[p + k] & 0x3F)
            points[some] = x
    kinds = _CLASS[points]
    if (kinds == UNKNOWN).any():
        _look_up(np.unique(points[kinds == UNKNOWN]))
        kinds = _CLASS[points]
    return at, points, kinds


def _contractions(points: np.ndarray, cut: np.ndarray, first: np.ndarray) -> None:
    """Moves the cuts behind an apostrophe that begins a token to behind its ending.  first: the characters that begin a part."""
    n = len(points)
    for p in np.flatnonzero((points == 39) & cut).tolist():
        for ending in ENDINGS:
            e = p + 1 + len(ending)
            if e <= n and not first[p + 1:e].any() and all(points[p + 1 + k] == ord(c) for k, c in enumerate(ending)):
                cut[p + 1:e] = False
                if e < n:
                    cut[e] = True
                break


def split_spaced(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens that take one space before them; and which parts hold characters this table can't class.

    '(?:[sdmt]|ll|ve|re)| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds) - 1, bool)
    at, points, kind = chars(data)
    n = len(at)
    first = np.zeros(n + 1, bool)
    first[np.searchsorted(at, bounds)] = True
    first[n] = True
    space = kind == S
    cut = np.empty(n, bool)
    cut[0] = True
    cut[1:] = np.where(space[1:], ~space[:-1] | ~np.append(space[2:] | first[2:n], True), np.where(space[:-1], points[:-1] != 32, kind[1:] != kind[:-1]))
    cut |= first[:n]
    _contractions(points, cut, first)
    starts = at[cut]
    return starts, np.append(starts[1:], len(data)), _unsure(at, kind, bounds)


def split_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As split_spaced, for the pattern without white space; digits stand alone.

    's|'t|'re|'ve|'m|'ll|'d|\\p{L}+|\\p{N}|[^\\s\\p{L}\\p{N}]+
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds) - 1, bool)
    at, points, kind = chars(data)
    n = len(at)
    first = np.zeros(n + 1, bool)
    first[np.searchsorted(at, bounds)] = True
    cut = np.empty(n, bool)
    cut[0] = True
    cut[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == N)
    cut |= first[:n]
    _contractions(points, cut, first)
    starts = at[cut]
    keep = kind[cut] != S
    return starts[keep], np.append(starts[1:], len(data))[keep], _unsure(at, kind, bounds)


def _unsure(at: np.ndarray, kind: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    odd = np.zeros(len(bounds) - 1, bool)
    if (kind == UNSURE).any():
        odd[np.searchsorted(bounds, at[kind == UNSURE], "right") - 1] = True
    return odd


def _extended(held: np.ndarray, n: int, more: np.ndarray) -> tuple[np.ndarray, int]:
    """An array whose first n values are in use, with more behind them; its room doubles."""
    if n + len(more) > len(held):
        held = np.concatenate([held[:n], np.empty(max(len(held), len(more)) + n, held.dtype)])
    held[n:n + len(more)] = more
    return held, n + len(more)


class Memo:
    """Value list of each distinct pre-token: an open-addressing table over its hash, checked by its whole content: the first and last 8 bytes,
    and for those of more than 16 the bytes themselves, which are kept.

    Emptied when it holds `most` entries or MOST_BYTES of long ones, so memory is bounded; that changes what is computed again, never a result.
    """

    MOST_BYTES = 32 << 20

    def __init__(self, compute: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], bits: int = 20):
        self.compute, self.bits, self.most = compute, bits, (1 << bits) * 6 // 10
        self.clear()

    def clear(self) -> None:
        self.slot = np.full(1 << self.bits, -1, np.int32)
        self.n = self.n_values = self.n_long = 0
        self.keys, self.heads, self.tails, self.sizes = (np.empty(self.most, np.uint64) for _ in range(4))
        self.starts, self.lengths, self.long_at = (np.empty(self.most, np.int64) for _ in range(3))
        self.values, self.long = np.empty(1 << 16, np.int32), np.empty(1 << 16, np.uint8)

    def _find(self, h: np.ndarray) -> np.ndarray:
        mask = np.uint64(len(self.slot) - 1)
        found = np.full(len(h), -1, np.int64)
        todo, at = np.arange(len(h)), (h & mask).astype(np.int64)
        while len(todo):
            entry = self.slot[at]
            there = entry >= 0
            todo, at, entry = todo[there], at[there], entry[there]
            same = self.keys[entry] == h[todo]
            found[todo[same]] = entry[same]
            todo, at = todo[~same], (at[~same] + 1) & int(mask)
        return found

    def _insert(self, h: np.ndarray, first: int) -> None:
        mask = len(self.slot) - 1
        todo, at = np.arange(len(h)), (h & np.uint64(mask)).astype(np.int64)
        while len(todo):
            free = self.slot[at] < 0
            _, one = np.unique(np.where(free, at, -1 - todo), return_index=True)
            put = np.zeros(len(todo), bool)
            put[one] = True
            put &= free
            self.slot[at[put]] = first + todo[put]
            todo, at = todo[~put], (at[~put] + 1) & mask

    def look_up(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry of each pre-token, and a mask of those whose hash belongs to another one (they need another way)."""
        padded = np.concatenate([np.zeros(8, np.uint8), data, np.zeros(8, np.uint8)])
        words = np.ndarray((len(data) + 9,), "<u8", padded.data, strides=(1,))
        size = (ends - starts).astype(np.uint64)
        short = np.minimum(size, np.uint64(8)) * np.uint64(8)
        head = words[starts + 8] << (np.uint64(64) - short)
        tail = words[ends]
        tail = np.where(size >= 8, tail, np.uint64(0))
        # Up to 16 bytes the two words and the size are the whole content.
        h = mix(mix(head + size * np.uint64(0x9E3779B97F4A7C15)) ^ tail * np.uint64(0xD1342543DE82EF95))
        big = np.flatnonzero(size > 16)
        h[big] = span_hashes(data, starts[big], ends[big])
        entry = self._find(h)
        lost = np.flatnonzero(entry < 0)
        if len(lost):
            if self.n + len(lost) > self.most or self.n_long > self.MOST_BYTES:
                self.clear()
                lost = np.arange(len(h))
            keys, one, which = np.unique(h[lost], return_index=True, return_inverse=True)
            one = lost[one]
            while len(self.slot) * 6 < len(keys) * 10:
                self.bits += 1
                self.most = (1 << self.bits) * 6 // 10
                self.clear()
            raw = data.tobytes()
            lengths, values = self.compute([raw[a:b] for a, b in zip(starts[one].tolist(), ends[one].tolist(), strict=True)])
            new = slice(self.n, self.n + len(keys))
            self.starts[new] = np.cumsum(lengths) - lengths + self.n_values
            self.lengths[new] = lengths
            self.values, self.n_values = _extended(self.values, self.n_values, values)
            self.keys[new], self.heads[new], self.tails[new], self.sizes[new] = keys, head[one], tail[one], size[one]
            over = np.where(size[one] > 16, ends[one] - starts[one], 0)
            self.long_at[new] = np.cumsum(over) - over + self.n_long
            if over.any():
                self.long, self.n_long = _extended(self.long, self.n_long, data[ragged(over, starts[one])])
            self._insert(keys, self.n)
            entry[lost] = self.n + which
            self.n += len(keys)
        other = (self.heads[entry] != head) | (self.tails[entry] != tail) | (self.sizes[entry] != size)
        big = big[~other[big]]
        if len(big):
            sizes = ends[big] - starts[big]
            equal = data[ragged(sizes, starts[big])] == self.long[ragged(sizes, self.long_at[entry[big]])]
            other[big] = ~np.logical_and.reduceat(equal, np.cumsum(sizes) - sizes)
        return entry, other

    def gather(self, entry: np.ndarray) -> np.ndarray:
        return self.values[ragged(self.lengths[entry], self.starts[entry])]
