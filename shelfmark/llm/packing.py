"""Packing by lexical retrieval: a BM25 index of each shard finds the documents that share a window with a seed.

Documents are dealt to shards by hash; a shard is an index of about a thousand documents or a few megabytes, whatever the size of the corpus.
Long documents first give whole windows.  Then each rest in turn is a seed: its terms are looked up in the inverted index of its shard
and the best-scoring rests that are unused follow it, the last one cut where the window ends; what is cut off stays in the index.  Only the last
window of a shard can be short.

A null text is an empty one: a document of the end id alone.  Rows that repeat, and rows with a null doc_id, are packed like any other; an empty
table gives no pieces.  Further columns are left out.  Texts are encoded whole; a single text over the shard size is a shard that much larger.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.byte_ids import byte_ids
from shelfmark.llm.common import id_text, ragged

LENGTH = 2048
SHARD_DOCS, SHARD_BYTES = 1024, 6 << 20
K1, B = 1.2, 0.75
AHEAD = 16  # ranked neighbours taken at a time


class Index:
    """BM25 postings over token ids."""

    def __init__(self, docs: list[np.ndarray]):
        n, sizes = len(docs), np.array([len(d) for d in docs])
        counted = [np.unique(d, return_counts=True) for d in docs]
        terms = np.concatenate([t for t, _ in counted])
        tf = np.concatenate([c for _, c in counted]).astype(np.float64)
        self.lengths = np.array([len(t) for t, _ in counted])
        self.begins = np.cumsum(self.lengths) - self.lengths
        doc = np.repeat(np.arange(n), self.lengths)
        distinct, self.term = np.unique(terms, return_inverse=True)
        df = np.bincount(self.term, minlength=len(distinct))
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        self.weight = idf[self.term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[doc] / sizes.mean()))
        order = np.argsort(self.term, kind="stable")
        self.docs, self.weights = doc[order], self.weight[order]
        self.sizes, self.ends, self.n = df, np.cumsum(df), n

    def scores(self, seed: int) -> np.ndarray:
        """Of all documents, for the seed's distinct terms."""
        some = self.term[self.begins[seed]:self.begins[seed] + self.lengths[seed]]
        at = ragged(self.sizes[some], self.ends[some] - self.sizes[some])
        return np.bincount(self.docs[at], self.weights[at], self.n)


def pack(docs: list[np.ndarray], length: int = LENGTH) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of one shard."""
    sizes = np.array([len(d) for d in docs])
    sequence = 0
    for d, n in enumerate(sizes.tolist()):
        for start in range(0, n - n % length, length):
            yield d, start, length, sequence, 0
            sequence += 1
    at, left = sizes - sizes % length, sizes % length
    index = Index(docs)
    for seed in range(len(docs)):
        while left[seed]:
            room = length

            def put(d: int):
                nonlocal room
                n = min(int(left[d]), room)
                piece = (d, int(at[d]), n, sequence, length - room)
                at[d] += n
                left[d] -= n
                room -= n
                return piece

            yield put(seed)
            if room:
                scores = np.where(left > 0, index.scores(seed), -1.0)
            while room and left.any():
                k = min(AHEAD, len(docs))
                best = np.argpartition(-scores, k - 1)[:k]
                best = best[np.lexsort((best, -scores[best]))]
                for d in best.tolist():
                    if room and left[d]:
                        yield put(d)
                        scores[d] = -1.0 if not left[d] else scores[d]
            sequence += 1


def _shards(tokenizer: str, end_id: int, length: int, kind: str):
    def out(shard: int, ids: list, tokens: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        rows = list(pack(tokens, length))
        for k in range(0, len(rows), 4096):
            d, start, n, sequence, offset = (np.array(c, np.int64) for c in zip(*rows[k:k + 4096], strict=True))
            pieces = [tokens[x][a:a + m] for x, a, m in zip(d.tolist(), start.tolist(), n.tolist(), strict=True)]
            batch = {"doc_id": pa.array([ids[x] for x in d.tolist()], pa.int64()), "start": pa.array(start), "length": pa.array(n),
                     "doc_tokens": pa.array([len(tokens[x]) for x in d.tolist()], pa.int64()), "sequence_id": pa.array((shard << 32) + sequence), "offset": pa.array(offset)}
            if kind == "ids":
                batch["ids"] = pa.array([p.astype(np.int32) for p in pieces], pa.list_(pa.int32()))
            else:
                batch["ids_crc32"] = pa.array([zlib.crc32(p.astype("<u4")) for p in pieces], pa.int64())
            yield pa.RecordBatch.from_pydict(batch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, ids, tokens = byte_ids(tokenizer), None, [], []
        for batch in batches:
            shards, docs = batch.column("shard").to_pylist(), batch.column("doc_id").to_pylist()
            for i, found in encoder.encode(batch.column("text")):
                if shards[i] != shard:
                    if tokens:
                        yield from out(shard, ids, tokens)
                    shard, ids, tokens = shards[i], [], []
                ids.append(docs[i])
                tokens.append(np.append(found, end_id).astype(np.uint16 if end_id < 1 << 16 and (not len(found) or found.max() < 1 << 16) else np.uint32))
        if tokens:
            yield from out(shard, ids, tokens)
    return run


def packed(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = 1, kind: str = "ids") -> DataFrame:
    """A row for every piece: doc_id, start, length, doc_tokens, sequence_id, offset, and its ids (kind "ids") or their crc32 (kind "digest")."""
    docs = id_text(docs)
    n, size = docs.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    shards = max(1, -(-n // SHARD_DOCS), -(-(size or 0) // SHARD_BYTES))
    dealt = docs.withColumn("h", F.xxhash64("text")).withColumn("shard", F.pmod(F.xxhash64("doc_id", "h"), F.lit(shards)))
    dealt = dealt.repartition("shard").sortWithinPartitions("shard", "doc_id", "h").select("shard", "doc_id", "text")
    last = "ids array<int>" if kind == "ids" else "ids_crc32 long"
    return dealt.mapInArrow(_shards(tokenizer, end_id, length, kind), f"doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, {last}")
