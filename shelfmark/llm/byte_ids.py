"""Token ids of whole texts with the byte-level vocabulary: the library encodes each distinct pre-token once and any odd text whole."""

from __future__ import annotations

import codecs
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from shelfmark.llm.common import flat, slices
from shelfmark.llm.pretokens import Memo, split_spaced


GROUP = 64  # pre-tokens that go to the library as one text


def _characters() -> str:
    """The character that byte-level vocabularies have for each byte.  0xFF is in no UTF-8, so here it is the space that parts pre-tokens."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return "".join(chr(b if b in shown else next(others)) for b in range(255)) + " "


class ByteIds:
    """The library's own model merges; splitting has been done here, so pre-tokens reach it in the vocabulary's characters, many to a text and past
    its splitter.  Where each one's ids end is told by the bytes that an id stands for."""

    CHARACTERS = _characters()

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.library = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.bytes_of[list(vocabulary.values())] = [len(x) for x in vocabulary]
        self.merger = Tokenizer(self.library.model)
        self.merger.pre_tokenizer = CharDelimiterSplit(" ")
        self.memo = Memo(self._encode)

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        b"".join(words).decode()  # an error for what is no UTF-8
        texts = [codecs.charmap_decode(b"\xff".join(words[k:k + GROUP]), "strict", self.CHARACTERS)[0] for k in range(0, len(words), GROUP)]
        ids = np.concatenate([np.array(e.ids, np.int32) for e in self.merger.encode_batch_fast(texts, add_special_tokens=False)])
        upto = np.cumsum(self.bytes_of[ids])
        last = np.searchsorted(upto, np.cumsum(np.fromiter(map(len, words), np.int64, len(words))))
        return np.diff(last, prepend=-1), ids

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.int32)

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """(index, ids) of every text, in order."""
        data, offs = flat(texts)
        n, at, held = len(offs) - 1, 0, []
        odd: set[int] = set()
        if any(s in (raw := data.tobytes()) for s in self.special):
            odd = {i for i in range(n) if any(s in raw[offs[i]:offs[i + 1]] for s in self.special)}

        def done(i: int):
            whole = self.whole(bytes(data[offs[i]:offs[i + 1]]).decode()) if i in odd else np.concatenate(held) if held else np.zeros(0, np.int32)
            held.clear()
            return i, whole

        for part, bounds, owner in slices(data, offs):
            starts, ends, unsure = split_spaced(part, bounds)
            odd.update(owner[unsure].tolist())
            if len(starts):
                entry, wrong = self.memo.look_up(part, starts, ends)
                if wrong.any():
                    odd.update(owner[np.searchsorted(bounds, starts[wrong], "right") - 1].tolist())
                ids = self.memo.gather(entry)
                upto = np.concatenate([[0], np.cumsum(self.memo.lengths[entry])])[np.searchsorted(starts, bounds)]
            else:
                ids, upto = np.zeros(0, np.int32), np.zeros(len(bounds), np.int64)
            for k, i in enumerate(owner.tolist()):
                while at < i:
                    yield done(at)
                    at += 1
                held.append(ids[upto[k]:upto[k + 1]])
        while at < n:
            yield done(at)
            at += 1


@lru_cache(1)
def byte_ids(path: str) -> ByteIds:
    return ByteIds(path)
