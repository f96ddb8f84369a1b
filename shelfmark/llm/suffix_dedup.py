"""Removal of long repeated strings: every byte covered by a string of `length` bytes that also starts in a document with a smaller doc_id.

A text's windows of `length` bytes fall into pieces: consecutive windows whose least 16-byte hash is the same value, which is the piece's key, a
function of each window's content alone.  So equal windows have equal keys, and only pieces of equal keys need be compared:

1. Pieces are dealt by key as hashes (a task sends each distinct piece of its batch once).  A piece whose whole content occurs in a smaller
   document is removed whole.  What is left to compare are first occurrences whose key has other contents too.
2. Those pieces' bytes are dealt by key.  A task orders their suffixes block by block with difference-cover samples (cover_sort), where equal
   windows stand side by side, and reports windows that start in a smaller document.  Keys with very many contents are compared window by
   window instead, dealt by the window's bytes.
3. What was found goes back to the documents, which cut it out.

Matches are judged on the input and never cross documents; a null text is empty.  Rows without a doc_id lose nothing and cause no loss.  Rows that
repeat a doc_id lose nothing to each other.  Texts are handled whole, whatever their length; an empty table gives an empty result; further
columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import delete, flat, id_text, mix, ragged, written
from shelfmark.llm.cover_sort import equal_runs, sorted_suffixes
from shelfmark.llm.words import groups

LENGTH, GRAM, MOST_WINDOWS = 50, 16, 64
BLOCK_BYTES = 2 << 20
MANY = 20_000  # contents of one key


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """Least of each n consecutive values."""
    size = len(x) - n + 1
    step = 1
    while step * 2 <= n:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    return np.minimum(x[:size], x[n - step:n - step + size])


def pieces(data: np.ndarray, offs: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """document, first window, number of windows, key and content hash of every piece."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none
    grams = _grams(data)
    key = _least(grams, length - GRAM + 1)
    valid = np.zeros(len(key) + 1, np.int8)
    ends = np.maximum(offs[1:] - length + 1, offs[:-1])
    some = ends > offs[:-1]
    valid[offs[:-1][some]] += 1
    valid[ends[some]] -= 1
    inside = np.cumsum(valid[:-1]).astype(bool)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | (key[1:] != key[:-1])
    begins[offs[:-1][some]] = True
    first = np.flatnonzero(begins)
    doc = np.searchsorted(offs, first, "right") - 1
    last = np.minimum(np.append(first[1:], len(key)), ends[doc])
    parts = -(-(last - first) // MOST_WINDOWS)
    if (parts > 1).any():
        k = ragged(parts, np.zeros(len(parts), np.int64))
        first, last, doc = np.repeat(first, parts) + k * MOST_WINDOWS, np.repeat(last, parts), np.repeat(doc, parts)
    n = np.minimum(last - first, MOST_WINDOWS)
    return doc, first, n, key[first].view(np.int64), _contents(grams, first, n + length - 1).view(np.int64)


def _grams(data: np.ndarray) -> np.ndarray:
    """Hash of the 16 bytes from each position on."""
    words = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data).data, strides=(1,))
    return mix(words[:-8] * np.uint64(0x9E3779B97F4A7C15) ^ mix(words[8:]))


def _contents(grams: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hash of each span of 16 bytes or more: its grams side by side, the last one ending with it, each mixed with its place, and its size."""
    total = np.zeros(len(starts), np.uint64)
    for k in range(-(-int(sizes.max()) // GRAM) if len(sizes) else 0):
        some = np.flatnonzero(sizes > k * GRAM)
        at = starts[some] + np.minimum(k * GRAM, sizes[some] - GRAM)
        total[some] += mix(grams[at] ^ mix(np.full(1, k + 1, np.uint64)))
    return mix(total + sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _batch_pieces(texts: pa.Array, length: int) -> Iterator[tuple]:
    data, offs = flat(texts)
    for i, j in groups(offs):
        part = data[offs[i]:offs[j]]
        doc, first, n, key, content = pieces(part, offs[i:j + 1] - offs[i], length)
        yield i, j, part, doc, first, n, key, content


def _keyed(length: int):
    """key, content, doc, late: each distinct piece of a batch with its smallest document; other documents of the batch are late."""
    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            found = [(ids[i + doc], key, content) for i, _, _, doc, _, _, key, content in _batch_pieces(batch.column("text"), length)]
            if not found:
                continue
            doc, key, content = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((doc, content))  # equal contents have equal keys
            doc, key, content = doc[order], key[order], content[order]
            other = np.append(True, (key[1:] != key[:-1]) | (content[1:] != content[:-1])) if len(key) else np.zeros(0, bool)
            one = other.copy()
            one[1:] |= doc[1:] != doc[:-1]
            for k in range(0, len(key), 1 << 16):
                o = one[k:k + (1 << 16)]
                yield pa.RecordBatch.from_pydict({"key": key[k:k + (1 << 16)][o], "content": content[k:k + (1 << 16)][o], "doc": doc[k:k + (1 << 16)][o],
                                                  "late": pa.array((~other[k:k + (1 << 16)][o]))})
    return run


def _names(doc: np.ndarray, key: np.ndarray, content: np.ndarray) -> np.ndarray:
    """One number for a piece of a document."""
    return mix(key.view(np.uint64) ^ mix(content.view(np.uint64) + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def _listed(lists: pa.Array, *fields: str) -> tuple[np.ndarray, ...]:
    """The row of each listed struct, and its fields; a null is an empty list."""
    sizes = np.diff(np.frombuffer(lists.buffers()[1], np.int32, len(lists) + 1, lists.offset * 4)).astype(np.int64) if len(lists) else np.zeros(0, np.int64)
    sizes[np.array(lists.is_null().to_pylist(), bool)] = 0
    every = lists.flatten()
    return np.repeat(np.arange(len(lists)), sizes), *(every.field(x).to_numpy(zero_copy_only=False) for x in fields)


def _binary(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data[ragged(sizes, starts)])])


def _cut_out(length: int):
    """key, content, doc, many, bytes of the pieces that are listed with each document."""
    def run(batches):
        for batch in batches:
            ids = batch.column("doc").to_numpy(zero_copy_only=False)
            w_doc, w_key, w_content, w_many = _listed(batch.column("wanted"), "key", "content", "many")
            for i, j, part, doc, first, n, key, content in _batch_pieces(batch.column("text"), length):
                lo, hi = np.searchsorted(w_doc, [i, j])
                asked, one = np.unique(_names(w_doc[lo:hi] - i, w_key[lo:hi], w_content[lo:hi]), return_index=True)
                mine, place = np.unique(_names(doc, key, content), return_index=True)  # of a piece that a document repeats, the first
                if not len(mine):
                    continue
                at = np.minimum(np.searchsorted(mine, asked), len(mine) - 1)
                there = mine[at] == asked
                at, many = place[at[there]], w_many[lo:hi][one[there]]
                order = np.argsort(at)
                for k in range(0, len(at), 1 << 16):
                    o = order[k:k + (1 << 16)]
                    x = at[o]
                    yield pa.RecordBatch.from_pydict({"key": pa.array(key[x]), "content": pa.array(content[x]), "doc": pa.array(ids[i + doc[x]]), "many": pa.array(many[o]),
                                                      "bytes": _binary(part, first[x], n[x] + length - 1)})
    return run


PART = "doc long, key long, content long, a int, b int"


def _repeated(hashes: np.ndarray) -> np.ndarray:
    order = np.argsort(hashes)
    equal = hashes[order[1:]] == hashes[order[:-1]]
    out = np.zeros(len(hashes), bool)
    out[order[1:][equal]] = True
    out[order[:-1][equal]] = True
    return out


def _spans(docs: np.ndarray, keys: np.ndarray, contents: np.ndarray, text: np.ndarray, sizes: np.ndarray, length: int) -> pa.RecordBatch:
    """Runs of windows (from a to b, exclusive) of each piece that start in a smaller document too, over one block of pieces.

    A window whose hash no other window of the block has is equal to none, so only the others, and the pieces that hold them, are put in order."""
    starts = np.cumsum(sizes) - sizes
    n = sizes - length + 1
    at = ragged(n, starts)
    grams, owner = _grams(text), np.repeat(np.arange(len(n)), n)
    twice = _repeated(_contents(grams, at, np.full(len(at), length)))
    some = np.flatnonzero(np.bincount(owner[twice], minlength=len(n)))
    docs, keys, contents, twice = docs[some], keys[some], contents[some], twice[ragged(n[some], (np.cumsum(n) - n)[some])]
    text, sizes, n = text[ragged(sizes[some], starts[some])], sizes[some], n[some]
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(n)), n)
    at = ragged(n, starts)
    place = np.full(len(text), -1, np.int64)
    place[at] = np.arange(len(at))
    hit = np.zeros(len(at), bool)
    for order in sorted_suffixes(text, at[twice], length):
        run = equal_runs(text, order, length)
        who = docs[owner[place[order]]]
        begins = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
        least = np.minimum.reduceat(who, begins)[run]
        hit[place[order]] = who > least
    same = np.append(False, owner[1:] == owner[:-1])
    before = np.append(False, hit[:-1]) & same
    after = np.append(hit[1:], False) & np.append(same[1:], False)
    a, b = np.flatnonzero(hit & ~before), np.flatnonzero(hit & ~after)
    o = owner[a]
    base = (np.cumsum(n) - n)[o]
    return pa.RecordBatch.from_pydict({"doc": docs[o], "key": keys[o], "content": contents[o], "a": (a - base).astype(np.int32), "b": (b + 1 - base).astype(np.int32)})


def _compared(length: int):
    """Rows come sorted by key; blocks of whole keys."""
    def run(batches):
        held: list[tuple] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offs = flat(batch.column("bytes"))
            held.append((*(batch.column(x).to_numpy(zero_copy_only=False) for x in ("doc", "key", "content")), data, np.diff(offs)))
            size += len(data)
            if size > BLOCK_BYTES:
                docs, keys, contents, text, sizes = (np.concatenate(x) for x in zip(*held, strict=True))
                k = int(np.append(0, np.flatnonzero(keys != keys[-1]) + 1)[-1])  # where the last key begins: it may go on
                b = int(sizes[:k].sum())
                if k:
                    yield _spans(docs[:k], keys[:k], contents[:k], text[:b], sizes[:k], length)
                held, size = [(docs[k:], keys[k:], contents[k:], text[b:], sizes[k:])], len(text) - b
        if held:
            yield _spans(*(np.concatenate(x) for x in zip(*held, strict=True)), length)
    return run


def _windows(length: int):
    def run(batches):
        for batch in batches:
            for k, c, d, raw in zip(*(batch.column(x).to_pylist() for x in ("key", "content", "doc", "bytes")), strict=True):
                n = len(raw) - length + 1
                yield pa.RecordBatch.from_pydict({"window": pa.array([raw[i:i + length] for i in range(n)], pa.binary()), "doc": pa.array([d] * n, pa.int64()), "key": pa.array([k] * n, pa.int64()),
                                                  "content": pa.array([c] * n, pa.int64()), "a": pa.array(range(n), pa.int32()), "b": pa.array(range(1, n + 1), pa.int32())})
    return run


def _removed(length: int, keep_text: bool):
    """The result row of each document; found lists its pieces (key, content) with runs of windows."""
    def run(batches):
        for batch in batches:
            f_doc, f_key, f_content, f_a, f_b = _listed(batch.column("found"), "key", "content", "a", "b")
            _, every = flat(batch.column("text"))
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
            texts = []
            for i, j, part, doc, first, n, key, content in _batch_pieces(batch.column("text"), length):
                lo, hi = np.searchsorted(f_doc, [i, j])
                mine = _names(doc, key, content)
                theirs = _names(f_doc[lo:hi] - i, f_key[lo:hi], f_content[lo:hi])
                order = np.argsort(mine, kind="stable")
                left, right = np.searchsorted(mine[order], theirs), np.searchsorted(mine[order], theirs, "right")
                at = order[ragged(right - left, left)]
                a, b = np.repeat(f_a[lo:hi], right - left), np.repeat(f_b[lo:hi], right - left)
                edge = np.bincount(first[at] + a, minlength=len(part) + 1) - np.bincount(first[at] + np.where(b < 0, n[at], b) + length - 1, minlength=len(part) + 1)
                gone = np.cumsum(edge[:-1]) > 0
                offs = every[i:j + 1] - every[i]
                for d in range(j - i):
                    mask = gone[offs[d]:offs[d + 1]]
                    kept = part[offs[d]:offs[d + 1]][~mask].tobytes()
                    out["n_bytes"].append(len(mask))
                    out["n_removed"].append(int(mask.sum()))
                    out["n_spans"].append(int((mask & ~np.append(False, mask[:-1])).sum()) if len(mask) else 0)
                    out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                    texts.append(kept.decode(errors="ignore") if keep_text else None)
            columns = {"doc_id": batch.column("doc_id")} | {k: pa.array(v, pa.string() if k == "kept_sha256" else pa.int64()) for k, v in out.items()}
            if keep_text:
                columns["kept_text"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_pydict(columns)
    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row, and kept_text if asked for (characters cut in two are left out of it)."""
    docs = id_text(docs)
    known = docs.filter("doc_id IS NOT NULL")
    keyed = known.mapInArrow(_keyed(length), "key long, content long, doc long, late boolean")
    # Late rows are known to be repeats; they pass by themselves, so that a piece of very many documents gathers a row for each batch only.
    keyed = keyed.withColumn("apart", F.when(F.col("late"), F.col("doc")))
    keyed = keyed.repartition("key", "apart").sortWithinPartitions("key", "apart", "content")  # one order serves both windows
    by_key, by_piece = Window.partitionBy("key", "apart"), Window.partitionBy("key", "apart", "content")
    seen = keyed.select("key", "content", "doc", "late", F.min("doc").over(by_piece).alias("first"), F.min("content").over(by_key).alias("c1"),
                        F.max("content").over(by_key).alias("c2"), F.count("*").over(by_key).alias("n"))
    seen = seen.withColumn("whole", F.col("late") | (F.col("first") < F.col("doc"))).filter("whole OR c1 <> c2")
    shared = written(seen.select("key", "content", "doc", "whole", (F.col("n") > MANY).alias("many")), "repeat-pieces")

    asked = shared.filter("NOT whole").groupBy("doc").agg(F.collect_list(F.struct("key", "content", "many")).alias("wanted"))  # at most a document's pieces
    cut = asked.join(known, asked.doc == known.doc_id).select("doc", "text", "wanted")
    cut = written(cut.mapInArrow(_cut_out(length), "key long, content long, doc long, many boolean, bytes binary"), "repeat-bytes")
    few = cut.filter("NOT many").repartition("key").sortWithinPartitions("key")
    parts = few.mapInArrow(_compared(length), PART)
    windows = cut.filter("many").mapInArrow(_windows(length), "window binary, " + PART)
    least = windows.groupBy("window").agg(F.min("doc").alias("least"))
    parts = written(parts.union(windows.join(least, "window").filter("least < doc").select("doc", "key", "content", "a", "b")), "repeat-parts")
    delete(cut)
    found = parts.union(shared.filter("whole").select("doc", "key", "content", F.lit(0).alias("a"), F.lit(-1).alias("b")))
    found = found.groupBy("doc").agg(F.collect_list(F.struct("key", "content", "a", "b")).alias("found"))
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept_text string" if keep_text else "")
    return docs.join(found, docs.doc_id == found.doc, "left").select("doc_id", "text", "found").mapInArrow(_removed(length, keep_text), out)
