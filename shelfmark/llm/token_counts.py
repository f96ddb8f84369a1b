"""Token counts of whole texts, by merging the pre-tokens of a batch side by side.

Each distinct pre-token is a sequence in a ragged array of symbols.  In every round each sequence finds its lowest-ranked pair and merges it
wherever it stands, from left to right, all sequences at once; a sequence without a ranked pair is done, and its symbols are its tokens.
Merging all places of a pair in one round is exact only if no merge of the new symbol ranks below it; the vocabulary is checked for that.

A null text is empty (0 bytes, 0 tokens), rows are kept one by one (repeated ones too), an empty table gives an empty result, and any
further columns are left out.  Texts are counted whole, whatever their length.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfmark.llm.common import flat, id_text, slices
from shelfmark.llm.pretokens import Memo, split_words

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _byte_names() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else the next one from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class RankMerger:
    """Counts of symbols left when the merges of a vocabulary have been applied to byte sequences."""

    def __init__(self, model: dict):
        vocab = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = (left << 32) | right
        self.order = np.argsort(keys, kind="stable")
        self.keys, self.rank_of, self.made = keys[self.order], np.arange(len(pairs))[self.order], made
        names = _byte_names()
        self.symbols = np.array([vocab[c] for c in names], np.int64)
        self.last_symbols = np.array([vocab[c + suffix] for c in names], np.int64)
        first_use = np.full(max(vocab.values()) + 1, len(pairs), np.int64)
        np.minimum.at(first_use, left, np.arange(len(pairs)))
        np.minimum.at(first_use, right, np.arange(len(pairs)))
        self.together = bool((first_use[made] > np.arange(len(pairs))).all())

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of[at], len(self.keys))

    def counts(self, words: list[bytes]) -> np.ndarray:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        out = sizes.copy()
        raw = np.frombuffer(b"".join(words), np.uint8)
        seq = np.repeat(np.arange(len(words)), sizes)
        sym = self.symbols[raw]
        ends = np.cumsum(sizes)[sizes > 0] - 1
        sym[ends] = self.last_symbols[raw[ends]]
        none = len(self.keys)
        rank = np.full(len(sym), none, np.int64)  # of the pair that begins at each symbol
        if len(sym) > 1:
            rank[:-1] = np.where(seq[1:] == seq[:-1], self.ranks(sym[:-1], sym[1:]), none)
        while len(sym):
            begins = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
            lowest = np.minimum.reduceat(rank, begins)
            lengths = np.diff(np.append(begins, len(sym)))
            out[seq[begins]] = lengths
            active = np.repeat(lowest < none, lengths)
            if not active.all():
                seq, sym, rank = seq[active], sym[active], rank[active]
                lowest, lengths = lowest[lowest < none], lengths[lowest < none]
                if not len(sym):
                    break
            hit = rank == np.repeat(lowest, lengths)
            p = np.flatnonzero(hit)
            if self.together:  # of pairs that overlap (aaa), every second one from the left
                run = np.append(True, np.diff(p) != 1)
                p = p[(np.arange(len(p)) - np.flatnonzero(run)[np.cumsum(run) - 1]) % 2 == 0]
            else:
                p = p[np.append(True, seq[p[1:]] != seq[p[:-1]])]
            sym[p] = self.made[rank[p]]
            keep = np.ones(len(sym), bool)
            keep[p + 1] = False
            new_at = np.cumsum(keep) - 1
            seq, sym, rank = seq[keep], sym[keep], rank[keep]
            q = new_at[p]
            stale = np.unique(np.concatenate([q, np.maximum(q - 1, 0)]))
            nxt = np.minimum(stale + 1, len(sym) - 1)
            rank[stale] = np.where((seq[stale] == seq[nxt]) & (nxt > stale), self.ranks(sym[stale], sym[nxt]), none)
        return out


class TokenCounter:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.merger = RankMerger(spec["model"])
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.split = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))))
        self.memo = Memo(self._count)

    def _count(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lowered = [w if w.isascii() else w.decode().lower().encode() for w in words]
        return np.ones(len(words), np.int64), self.merger.counts(lowered).astype(np.int32)

    def _normal(self, text: str) -> list[str]:
        """Normalised stretches between special strings."""
        return [self.library.normalizer.normalize_str(part) for part in self.split.split(text)]

    def count(self, texts: pa.Array) -> np.ndarray:
        data, offs = flat(texts)
        n = len(offs) - 1
        total = np.zeros(n, np.int64)
        # The vectorised way holds for characters below U+0250 whose lower case is one letter; U+0130 is not.
        raw = data.tobytes()
        high = np.flatnonzero((data >= 0xCA) | ((data == 0xB0) & (np.append(0, data[:-1]) == 0xC4)))[:]
        odd = np.zeros(n, bool)
        odd[np.searchsorted(offs, high, "right") - 1] = True
        if any(s.encode() in raw for s in self.special):
            odd |= np.array([any(s.encode() in raw[offs[i]:offs[i + 1]] for s in self.special) for i in range(n)])
        if odd.any():  # the library normalises these; then they are split and merged like the others
            owners, stretches = [], []
            for i in np.flatnonzero(odd).tolist():
                text = raw[offs[i]:offs[i + 1]].decode()
                total[i] += len(self.split.findall(text))
                for s in self._normal(text):
                    owners.append(i)
                    stretches.append(s)
            late = self._counted(*flat(pa.array(stretches, pa.large_string())))
            for i, (k, unsure) in zip(owners, zip(*late, strict=True), strict=True):
                total[i] += k
                if unsure:
                    total[i] = -1 << 40
            for i in {i for i in owners if total[i] < 0}:
                total[i] = len(self.library.encode(raw[offs[i]:offs[i + 1]].decode(), add_special_tokens=False).ids)
        # blank out what has been counted, so that the rest stays one flat array
        rest = data
        if odd.any():
            rest = data.copy()
            for i in np.flatnonzero(odd).tolist():
                rest[offs[i]:offs[i + 1]] = 32
        counts, unsure = self._counted(_LOWER[rest], offs)
        total += counts
        for i in np.flatnonzero(unsure).tolist():
            total[i] = len(self.library.encode(raw[offs[i]:offs[i + 1]].decode(), add_special_tokens=False).ids)
        return total

    def _counted(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total, odd = np.zeros(len(offs) - 1, np.int64), np.zeros(len(offs) - 1, bool)
        for part, bounds, owner in slices(data, offs):
            starts, ends, unsure = split_words(part, bounds)
            odd[owner[unsure]] = True
            if len(starts):
                entry, wrong = self.memo.look_up(part, starts, ends)
                if wrong.any():
                    odd[owner[np.searchsorted(bounds, starts[wrong], "right") - 1]] = True
                sums = np.append(0, np.cumsum(self.memo.values[self.memo.starts[entry]], dtype=np.int64))
                upto = sums[np.searchsorted(starts, bounds)]
                np.add.at(total, owner, np.diff(upto))
        return total, odd


@lru_cache(1)
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row; no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = counter(tokenizer).count(batch.column("text"))
            _, offs = flat(batch.column("text"))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_bytes": pa.array(np.diff(offs), pa.int64()),
                                              "n_tokens": pa.array(n, pa.int64()), "over_limit": pa.array(n > limit)})
    return id_text(docs).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
