"""Benchmark decontamination: windows of benchmark words found in documents.

The windows of all items, lower-cased, form a hash set that every executor gets; tasks hash the word windows of whole texts, look them up and
compare the words of each hit.  If the benchmark's text is beyond `most_bytes`, nothing is broadcast: windows are joined by their words.

A null or empty text has no words and no hits.  Items without words, or without an id, are left out; an item id that repeats is one item with
the windows of all its rows.  Rows that repeat, and rows with a null doc_id, are rows of their own.  Empty tables give no hits.
Further columns of the documents are kept by remove_leaks() and left out by leaks().
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import flat, free_names, id_text
from shelfmark.llm.words import ALNUM, LOWER, groups, window_hashes, words

MOST_BYTES = 32 << 20  # benchmark text that is broadcast: about ten times as much as a hash set
BITS = 22


class WindowSet:
    """Benchmark windows by width: a bit table over their hashes, and for each hash the windows (as joined words) and their items."""

    def __init__(self, rows: list[tuple[str, str]], width: int):
        self.width, self.items = width, sorted({i for i, _ in rows})
        number = {x: k for k, x in enumerate(self.items)}
        found: dict[int, dict[bytes, set[int]]] = defaultdict(lambda: defaultdict(set))
        for item, text in rows:
            data = LOWER[np.frombuffer(text.encode(), np.uint8)]
            starts, ends, _, _ = words(data, np.array([0, len(data)]), ALNUM)
            n = min(width, len(starts))
            raw = data.tobytes()
            for k in range(len(starts) - n + 1 if n else 0):
                found[n][b" ".join(raw[a:b] for a, b in zip(starts[k:k + n], ends[k:k + n], strict=True))].add(number[item])
        self.by_width = {}
        for n, texts in found.items():
            joined = list(texts)
            data = np.frombuffer(b" ".join(joined), np.uint8)
            hashes = window_hashes(words(data, np.array([0, len(data)]), ALNUM)[2], n)[::n]
            exact: dict[int, list[tuple[bytes, set[int]]]] = defaultdict(list)
            for h, t in zip(hashes.tolist(), joined, strict=True):
                exact[h].append((t, texts[t]))
            bits = np.zeros(1 << BITS, bool)
            bits[(hashes >> np.uint64(64 - BITS)).astype(np.int64)] = True
            self.by_width[n] = (bits, np.unique(hashes), dict(exact))

    def hits(self, raw: bytes, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, upto: np.ndarray) -> Iterator[tuple[int, int, set[int]]]:
        """(first word, width, items) of each occurrence inside one document."""
        for n, (bits, known, exact) in self.by_width.items():
            h = window_hashes(hashes, n)
            maybe = np.flatnonzero(bits[(h >> np.uint64(64 - BITS)).astype(np.int64)])
            maybe = maybe[known[np.minimum(np.searchsorted(known, h[maybe]), len(known) - 1)] == h[maybe]]
            doc = np.searchsorted(upto, maybe, "right")
            maybe = maybe[maybe + n <= upto[doc]]
            for k in maybe.tolist():
                text = b" ".join(raw[a:b] for a, b in zip(starts[k:k + n].tolist(), ends[k:k + n].tolist(), strict=True))
                for t, items in exact[int(h[k])]:
                    if t == text:
                        yield k, n, items


def _scan(windows: WindowSet, texts: pa.Array):
    """For each text: number of words, hit runs as byte spans, hit words, items."""
    data, offs = flat(texts)
    for i, j in groups(offs):
        part = LOWER[data[offs[i]:offs[j]]]
        starts, ends, hashes, upto = words(part, offs[i:j + 1] - offs[i], ALNUM)
        hit = np.zeros(len(starts), bool)
        items: dict[int, set[int]] = defaultdict(set)
        for k, n, found in windows.hits(part.tobytes(), starts, ends, hashes, upto):
            hit[k:k + n] = True
            items[int(np.searchsorted(upto, k, "right")) - 1] |= found
        for d in range(j - i):
            if d not in items:
                yield int(upto[d + 1] - upto[d]), [], 0, []
                continue
            mine = hit[upto[d]:upto[d + 1]]
            s, e, base = starts[upto[d]:upto[d + 1]], ends[upto[d]:upto[d + 1]], int(offs[i + d] - offs[i])
            spans = [(a - base, b - base) for a, b in _runs(mine, s, e)]
            yield len(mine), spans, int(mine.sum()), sorted(windows.items[x] for x in items[d])


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").filter("item_id IS NOT NULL AND text IS NOT NULL")


def _fits(items: DataFrame, most_bytes: int) -> bool:
    return (items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0) <= most_bytes


def _windows(items: DataFrame, width: int):
    """The set, sent to every executor once; its size has been checked."""
    rows = [tuple(r) for r in items.collect()]
    return items.sparkSession.sparkContext.broadcast(WindowSet(rows, width))


def _by_words(df: DataFrame, widths: list[int] | None, width: int, key: list[str]) -> DataFrame:
    """key..., at, n, gram: the word windows of each row; without widths, those an item has."""
    def run(batches):
        for batch in batches:
            out, rows = [[], [], []], []
            data, offs = flat(batch.column("text"))
            for i in range(batch.num_rows):
                part = LOWER[data[offs[i]:offs[i + 1]]]
                starts, ends, _, _ = words(part, np.array([0, len(part)]), ALNUM)
                raw = part.tobytes()
                w = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                for n in widths if widths is not None else [min(width, len(w))] if w else []:
                    for k in range(len(w) - n + 1):
                        rows.append(i)
                        for o, x in zip(out, (k, n, b" ".join(w[k:k + n])), strict=True):
                            o.append(x)
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(c).take(take) for c in key] + [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], names=[*key, "at", "n", "gram"])
    kinds = dict(df.dtypes)
    return df.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in key) + ", at long, n long, gram binary")


def _joined(docs: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """d, g (document and hash of its text), items, places: the hits without a broadcast, both sides' windows meeting by their words."""
    known = _by_words(items, None, width, ["item_id"]).select("item_id", "n", "gram").distinct()
    widths = [r.n for r in known.select("n").distinct().collect()]  # at most `width` numbers
    hits = _by_words(docs.withColumn("h", F.xxhash64("text")), widths, width, ["doc_id", "h"]).join(known, ["n", "gram"])
    return hits.groupBy(F.col("doc_id").alias("d"), F.col("h").alias("g")).agg(
        F.array_sort(F.collect_set("item_id")).alias("items"), F.collect_set(F.struct("at", "n")).alias("places"))


def _joined_leaks(docs: DataFrame, items: DataFrame, width: int) -> DataFrame:
    hits = _joined(docs, items, width)
    n_words = F.size(F.filter(F.split(F.lower(F.col("text")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")).cast("long")
    places = F.flatten(F.transform("places", lambda p: F.sequence(p["at"], p["at"] + p["n"] - 1)))
    hits = hits.select("d", "g", "items", F.size(F.array_distinct(places)).cast("long").alias("n_hit"))
    left = docs.select("doc_id", F.xxhash64("text").alias("h"), n_words.alias("n_words"))
    return left.join(hits, left.doc_id.eqNullSafe(hits.d) & (left.h == hits.g), "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def leaks(docs: DataFrame, benchmark: DataFrame, width: int = 10, most_bytes: int = MOST_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit (words inside an occurrence), items (sorted ids as strings) of every row.  No shuffle of the documents."""
    docs, items = id_text(docs), _items(benchmark)
    if not _fits(items, most_bytes):
        return _joined_leaks(docs, items, width)
    shared = _windows(items, width)

    def run(batches):
        for batch in batches:
            n, _, hit, found = zip(*_scan(shared.value, batch.column("text")), strict=True) if batch.num_rows else ((), (), (), ())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_words": pa.array(n, pa.int64()), "n_hit": pa.array(hit, pa.int64()),
                                              "items": pa.array(found, pa.list_(pa.string()))})
    return docs.mapInArrow(run, "doc_id long, n_words long, n_hit long, items array<string>")


def digest(found: DataFrame) -> DataFrame:
    """The result columns that can be compared: items as a count and a hash."""
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def _cut(text: bytes, spans: list[tuple[int, int]]) -> str:
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]]).decode()


def _runs(hit: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Byte spans of the runs of hit words."""
    first = np.flatnonzero(hit & ~np.append(False, hit[:-1]))
    last = np.flatnonzero(hit & ~np.append(hit[1:], False))
    return [(int(starts[a]), int(ends[b])) for a, b in zip(first, last, strict=True)]


def _cut_places(text: str, schema, name: str):
    """As remove_leaks, for rows that carry the places of their hits."""
    def run(batches):
        for batch in batches:
            texts, places = batch.column(text), batch.column(name).to_pylist()
            new, keep = texts.to_pylist(), []
            for i, found in enumerate(places):
                if not found:
                    keep.append(True)
                    continue
                raw = new[i].encode()
                data = LOWER[np.frombuffer(raw, np.uint8)]
                starts, ends, _, _ = words(data, np.array([0, len(data)]), ALNUM)
                hit = np.zeros(len(starts), bool)
                for p in found:
                    hit[p["at"]:p["at"] + p["n"]] = True
                new[i] = _cut(raw, _runs(hit, starts, ends))
                keep.append(not hit.all())
            out = batch.set_column(batch.schema.get_field_index(text), text, pa.array(new, texts.type)).select(schema)
            yield out.filter(pa.array(keep, pa.bool_()))
    return run


def remove_leaks(docs: DataFrame, benchmark: DataFrame, width: int = 10, most_bytes: int = MOST_BYTES) -> DataFrame:
    """docs (doc_id, text and any other columns) with the hit words cut out, from the first to the last of each run; documents of which no words
    are left go.  A null text stays null."""
    items = _items(benchmark)
    if not _fits(items, most_bytes):
        doc, group, own, places = free_names(docs.columns, "hit_doc", "hit_group", "own_group", "hit_places")
        hits = _joined(id_text(docs), items, width).select(F.col("d").alias(doc), F.col("g").alias(group), F.col("places").alias(places))
        keyed = docs.withColumn(own, F.xxhash64(F.coalesce("text", F.lit(""))))
        both = keyed.join(hits, F.col("doc_id").cast("long").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(group)), "left").select(*docs.columns, places)
        return both.mapInArrow(_cut_places("text", docs.columns, places), docs.schema)
    shared = _windows(items, width)

    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            new, keep = texts.to_pylist(), []
            for i, (n, spans, hit, _) in enumerate(_scan(shared.value, texts)):
                if hit:
                    new[i] = _cut(new[i].encode(), spans)
                keep.append(hit < n or not hit)
            out = batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(new, texts.type))
            yield out.filter(pa.array(keep, pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
